"""Alignment of shifted and noisy recordings, and odd rows."""

import numpy as np

from presslake.llm import chroma


def test_alignment_finds_the_shift():
    rnd = np.random.default_rng(1)
    sound = chroma.tones(rnd.normal(size=400) / 2)
    a = chroma.fingerprint(sound)
    offset, wrong = chroma.align(a, chroma.fingerprint(sound[chroma.HOP * 37 :] + rnd.normal(size=len(sound) - chroma.HOP * 37) * 0.01))
    assert offset == 37 and wrong < 0.1
    other = chroma.align(a, chroma.fingerprint(chroma.tones(rnd.normal(size=400) / 2)))
    assert other is None or other[1] > 0.2


def test_filters_against_direct_sums():
    rnd = np.random.default_rng(2)
    sounds = [chroma.tones(rnd.normal(size=n) / 3) for n in (40, 64, 40, 9, 1)]
    for sound, items in zip(sounds, chroma.fingerprints_of(sounds), strict=True):
        frames = []
        for at in range(0, len(sound) - chroma.FRAME + 1, chroma.HOP):
            power = np.abs(np.fft.rfft(sound[at : at + chroma.FRAME] * np.hanning(chroma.FRAME))) ** 2
            energy = np.zeros(12)
            for k, p in enumerate(power):
                hertz = k * chroma.RATE / chroma.FRAME
                if hertz >= 55:
                    energy[int(np.round(12 * np.log2(hertz / 440))) % 12] += p
            frames.append(energy / max(np.sqrt((energy**2).sum()), 1e-9))
        want = []
        for at in range(len(frames) - chroma.SPAN + 1):
            x = np.array(frames[at : at + chroma.SPAN])
            bits = 0
            for t, w, c, h, kind in chroma.FILTERS:
                block = x[t : t + w, c : c + h]
                a, b = (block[: w // 2], block[w // 2 :]) if kind == 0 else (block[:, : h // 2], block[:, h // 2 :])
                value = round(float(np.log1p(max(a.sum(), 0)) - np.log1p(max(b.sum(), 0))), 9)
                bits = bits << 2 | (0, 1, 3, 2)[sum(value >= bound for bound in (-0.15, 0.0, 0.15))]
            want.append(bits)
        assert items.tolist() == want


def test_odd_rows(spark):
    printed = lambda t: chroma.fingerprints(t.withColumnsRenamed({"vec_id": "rec_id", "embedding": "samples"}), chroma.tones)
    rows = [(1, None, "c", "c"), (2, [], "c", "c"), (3, [0.1, None, float("nan")], "c", "c"), (None, [0.2] * 40, "c", "c"), (4, [0.1 * (i % 9) for i in range(64)], "c", "c"), (4, [0.1 * (i % 9) for i in range(64)], "c", "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, items string, sha256 string")
    out = printed(table).collect()
    assert len(out) == 6 and all(r.n_items == len(r["items"]) for r in out) and {r.rec_id: r.n_items for r in out}[1] == 0
    assert len({r.sha256 for r in out if r.rec_id == 4}) == 1 and printed(table.limit(0)).count() == 0


def test_matches_equal_the_alignment_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(chroma, "AT_ONCE", 500)  # recordings of more pairs than that go in parts
    rnd = np.random.default_rng(4)
    sounds = [chroma.tones(rnd.normal(size=90) / 8) for _ in range(12)]
    sounds += [sounds[0][chroma.HOP * 20 :], sounds[1] + rnd.normal(size=len(sounds[1])) * 0.01, np.zeros(9000), np.zeros(12000), sounds[2]]
    items = [chroma.fingerprint(x) for x in sounds]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(sounds)] + [(99, None)], "rec_id long, samples array<double>")
    got = {r.rec_id: r for r in chroma.matched(chroma.fingerprints(table), group_items=300).collect()}
    assert len(got) == 18 and (got[16].class_id, got[16].copies, got[2].copies) == (2, 2, 2) and got[99].class_id is None and got[99].matches == []
    sha = lambda i: bytes.fromhex(got[i].sha256)
    for i in range(16):
        want = {}
        for j in (j for j in range(16) if j != i):
            one, two = (i, j) if sha(i) < sha(j) else (j, i)
            if (found := chroma.align(items[one], items[two])) is None:
                continue
            shift, wrong = found
            overlap = min(len(items[one]), len(items[two]) + shift) - max(0, shift)
            if overlap >= min(chroma.LEAST, len(items[i]), len(items[j])) and wrong <= chroma.MOST_WRONG:
                want[j] = (shift if one == i else -shift, round(wrong, 9))
        assert {m.rec_id: (m.offset, round(m.wrong, 9)) for m in got[i].matches} == want
    assert [m.offset for m in got[0].matches if m.rec_id == 12] == [20] and 13 in {m.rec_id for m in got[1].matches}
