"""Typed settings from the environment, and a report on it."""

from __future__ import annotations

import os
import platform
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

PREFIX = "PRESSLAKE_"
_ON = {"on", "true", "1", "yes"}


@dataclass(frozen=True)
class Settings:
    """Every field is read from PRESSLAKE_<NAME>; switches are on for on, true, 1 and yes. Nothing secret is held here."""

    data_dir: str = "./data"
    user_agent: str = "presslake"
    contact: str = ""
    host_delay_s: float = 5.0
    per_host: int = 1
    per_address: int = 4
    in_flight: int = 32
    revisit_s: int = 86_400
    lease_s: int = 600
    verdict_ttl_days: int = 30
    keep_runs: int = 30
    max_articles: int = 5
    max_seen: int = 5
    filename_chars: int = 10
    group_filter: str = "%"
    sink: str = "files"
    removal: bool = False
    requests: bool = False
    status: bool = False
    faults: bool = True
    browser: bool = False

    @property
    def wire_sink(self) -> bool:
        return self.sink in {"wire", "tns", "mysql", "press_release"}

    def headers(self) -> dict[str, str]:
        """How captures that are taken for this engine should name themselves."""
        agent = f"{self.user_agent} (+{self.contact})" if self.contact else self.user_agent
        return {"User-Agent": agent} | ({"From": self.contact} if "@" in self.contact else {})


def parse_env(text: str) -> dict[str, str]:
    """NAME=value lines of a .env file: comments, blank lines and `export` aside, matching quotes off."""
    out = {}
    for line in text.lstrip("\ufeff").splitlines():
        name, found, value = line.strip().removeprefix("export ").partition("=")
        name, value = name.strip(), value.strip()
        if not found or not name or name.startswith("#"):
            continue
        if len(value) >= 2 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        out[name] = value
    return out


def load(env: Mapping[str, str] | None = None, file: str | None = ".env") -> Settings:
    """Settings of the environment, which goes before a .env file; a value that doesn't fit its type is an error that names it."""
    env = os.environ if env is None else env
    held = parse_env(Path(file).read_text("utf-8")) if file and Path(file).is_file() else {}
    held |= {k: v for k, v in env.items() if k.startswith(PREFIX)}
    values = {}
    for f in fields(Settings):
        raw = held.get(PREFIX + f.name.upper())
        if raw is None or raw == "":
            continue
        kind = type(f.default)
        try:
            values[f.name] = raw.strip().lower() in _ON if kind is bool else kind(raw.strip())
        except ValueError:
            raise ValueError(f"{PREFIX}{f.name.upper()}={raw!r} is no {kind.__name__}") from None
    return Settings(**values)


def doctor(spark=None, settings: Settings | None = None) -> dict[str, str]:
    """What the engine runs on: versions, and whether what it needs is there."""
    import pandas
    import pyarrow
    import pyspark

    settings = settings or load()
    out = {"python": platform.python_version(), "pyspark": pyspark.__version__, "pyarrow": pyarrow.__version__, "pandas": pandas.__version__}
    out["data_dir"] = "there" if Path(settings.data_dir).is_dir() else "missing"
    if spark is not None:
        out |= {"java": spark._jvm.System.getProperty("java.version"), "master": spark.sparkContext.master, "time_zone": spark.conf.get("spark.sql.session.timeZone"), "adaptive": spark.conf.get("spark.sql.adaptive.enabled")}
        shared = spark.conf.get("spark.checkpoint.dir", None)
        out["checkpoints"] = shared or ("own folder" if spark.sparkContext.master.startswith("local") else "spark.checkpoint.dir is missing")
    return out
