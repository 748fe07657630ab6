"""Language identification by compression: a text belongs to the language whose dictionary makes it smallest.

Each language's dictionary is raw content: training texts end to end. Texts are lower-cased, their runs of
other characters than letters become one blank, and they are cut into
chunks (so that a long text can't come to rest on its own beginning) and each chunk is compressed
with every dictionary; the sizes add up over the whole text. Where best and second best are close, the
prediction stands but `accepted` is false.

Training takes a bounded sample (`per_language` documents of each language, those with the smallest
hashes) of the rows that are not held out. Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"


def letters(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spread(data: bytes, size: int, pieces: int = 4) -> bytes:
    """size bytes of data in pieces from its beginning to its end; all of it if it is no longer."""
    if len(data) <= size or size < pieces:
        return data[: max(0, size)]
    step = size // pieces
    return b"".join(data[at : at + step] for at in ((len(data) - step) * i // (pieces - 1) for i in range(pieces)))


class CompressionClassifier:
    """languages, the commonest first, and their dictionaries; picklable, per language at most dictionary_bytes."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 6, chunk: int = 2048) -> None:
        self.dictionaries, self.level, self.chunk = dictionaries, level, chunk
        self._compressors = None

    def __reduce__(self):
        return CompressionClassifier, (self.dictionaries, self.level, self.chunk)

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes with each language's dictionary, in the order of dictionaries."""
        if self._compressors is None:
            self._compressors = []
            for content in self.dictionaries.values():
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=self.level)
                self._compressors.append(zstandard.ZstdCompressor(level=self.level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        data = letters(text)
        chunks = [data[i : i + self.chunk] for i in range(0, len(data), self.chunk)]
        return [sum(map(len, map(compress, chunks))) for compress in self._compressors]

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, margin). The margin is 1 - best / second; 1 with one language only; of equals the commoner language wins."""
        if not text or not self.dictionaries or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        sizes, names = self.sizes(text), list(self.dictionaries)
        ranked = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        return names[ranked[0]], 1 - sizes[ranked[0]] / sizes[ranked[1]] if len(ranked) > 1 else 1.0


def train(docs: DataFrame, per_language: int = 300, dictionary_bytes: int = 300_000, max_languages: int = 256, **options) -> CompressionClassifier:
    """Learns from text and non-null lang of rows that are not held out; each text gives pieces of up to an equal share of dictionary_bytes.

    The sample is bounded by per_language rows and dictionary_bytes of each language; more than max_languages values of lang are an error,
    since every text is compressed once for each.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rated = known.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(rated) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    counts = {r["lang"]: r["count"] for r in rated}
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= per_language).select("doc_id").distinct()
    # at most per_language ids for each of max_languages: the bound that makes this broadcast safe
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id").toPandas().sort_values(["lang", "doc_id", "text"])
    dictionaries = {}
    for lang, own in sorted(rows.groupby("lang"), key=lambda x: (-counts[x[0]], x[0])):
        texts = [letters(t) for t in own["text"] if _LETTER.search(t)]
        share = dictionary_bytes // max(1, len(texts)) - 1  # a line end goes with each
        content = b"\n".join(spread(t, share) for t in texts)
        if len(content) >= 8:
            dictionaries[lang] = content
    return CompressionClassifier(dictionaries, **options)


PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])


def identify(docs: DataFrame, classifier: CompressionClassifier, margin: float = 0.02) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the margin, 0 to 1) and accepted (score >= margin) of every whole text.

    Text that is null or has no letter, and any text when no language was learned, gives `und` with score 0.
    Null ids stay, repeated rows each give a row, an empty table gives none; only doc_id and text are read.
    """

    def start():
        def f(batch):
            found = [classifier.predict(t) for t in batch.column(2).to_pylist()]
            return [batch.column(0), batch.column(1), [x[0] for x in found], [min(1.0, max(0.0, x[1])) for x in found], [x[0] != UNDETERMINED and x[1] >= margin for x in found]]

        return f

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"), PREDICTED, start)
