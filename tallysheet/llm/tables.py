"""Small helpers the operators share: table access, stored intermediate results, row numbers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallysheet.scratch import scratch_dir

# Fixed value: what separates words, in every operator that counts words (see ``words``).
WORD_SEPARATORS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table. Python workers get the folder of this package on their path, for sessions
    that were started elsewhere; on a cluster the package is installed or sent with the job."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH", ""), root]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the folder that all executors share and read it back: what follows
    neither computes it again nor depends on the executors that made it."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column (in any case) has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns that would clash with the ones an operator adds."""
    clash = {n.lower() for n in names}
    return df.select([df[f"`{c}`"] for c in df.columns if c.lower() not in clash])


def words(text: str | None) -> list[bytes]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]``; ``bytes.split`` separates at exactly those."""
    return text.encode().split() if text else []
