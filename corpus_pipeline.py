"""A training-corpus pipeline: toxicity, exact dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Between stages `run` writes the rows as Parquet in the
shared folder and reads them again. All stages but the last return rows with the columns of documents; a stage works on all
rows that its predecessor kept. Stages may also be called one on another's result without a write in between. Tables that a
stage made for itself are removed by `run` once its result is written; of stages that are called alone, when this thread calls
a later one for the same folder on rows that are not read from them.

Defined cases, for all stages: an empty table gives an empty one, with the same columns before packing. Null texts are
empty: they are never toxic, are copies of each other and of empty texts, have size 0 in the mix (where they rank
as any other) and are one piece with the end id. Null ids are less than any other where the largest stays, and more
than any other where the smallest stays; exactly one row of a class stays even if ids repeat. Repeated rows are exact
copies. A null source is a source of its own. Very long texts are read whole and packed in pieces. Further columns are
carried up to packing, whatever their names.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import dedup, mixing, near_dedup, packing, toxicity
from tapewright.llm.shared import collecting, folders_read, free_name, remove, stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not call toxic; it learns from the labels of the folder."""
    predicted = free_name(docs, "predicted")
    scored = toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=True)
    return scored.where(F.col(predicted) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dedup.kept_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: sources come near their target shares."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequence and offset; repeated rows are packed as often as they come."""
    return packing.pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders of tables that stages called alone have left, by application, input and thread: (position of the stage, folder).
_left: dict[tuple[str, str, int], list[tuple[int, str]]] = defaultdict(list)


def _tidy(position: int, stage: Stage) -> Stage:
    """The stage, which first removes what stages before it left for themselves, unless its rows are still read from there."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, threading.get_ident())
        read = folders_read(docs)
        if read is not None:
            done = [folder for at, folder in _left[key] if at < position and not any(_within(r, folder) for r in read)]
            remove(spark, *done)
            _left[key] = [x for x in _left[key] if x[1] not in done]
        with collecting() as made:
            out = stage(spark, docs, sf_dir)
        _left[key] += [(position, folder) for folder in made]
        return out

    run_stage.plain = stage
    return run_stage


def _within(path: str, folder: str) -> bool:
    """Whether a path lies in a folder, however their schemes are written."""
    bare = lambda p: "/" + p.split(":", 1)[-1].lstrip("/")
    return bare(path).startswith(bare(folder).rstrip("/") + "/")


STAGES: list[tuple[str, Stage]] = [
    (name, _tidy(k, stage))
    for k, (name, stage) in enumerate([
        ("toxicity", reject_toxic),
        ("exact_dedup", drop_exact_copies),
        ("near_dedup", drop_near_copies),
        ("mixing", mix_sources),
        ("packing", pack),
    ])
]

#: SQL cannot state the network, the signatures and the packing; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with collecting() as own:
            out = stage.plain(spark, docs, sf_dir)
        with collecting() as made:
            docs = stored(out, name)
        remove(spark, *own, *written)
        written = made
    return docs
