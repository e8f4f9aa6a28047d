"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing, packing.

Each stage reads the documents that its predecessor kept, from Parquet, and all but the last return the columns of documents.

Defined cases, beside those of each operator: null texts and texts without words fail the quality rules; rows equal in doc_id and text count as one document after
dedup, that of the least other columns; rows with null doc_ids are documents; very long texts pass whole and are packed in pieces; extra columns pass all
stages but the last; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellpub.llm.common import collecting, release, stored
from cellpub.llm.exact_dedup import drop_copies
from cellpub.llm.mixing import take_copies
from cellpub.llm.near_dedup import drop_near
from cellpub.llm.packing import packed
from cellpub.llm.quality_rules import keep_good


class Run:
    """Runs of the stages, one for each input folder. When a stage begins, the documents it gets are written already, so what the stage before stored for that folder is deleted, unless they are still read from it."""

    def __init__(self) -> None:
        self.dead: dict[str, list[str]] = {}

    def _stage(self, work: Callable[[DataFrame], DataFrame], keeps: bool = False) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            dead = self.dead.pop(sf_dir, [])
            names = [path.rsplit("/", 1)[-1] for path in dead]
            if dead and not any(f"/{name}/" in file for file in docs.inputFiles() for name in names):
                release(spark, dead)
            with collecting() as paths:
                out = work(docs)
            # The last stage's result may be read at any later time.
            self.dead[sf_dir] = [] if keeps else paths
            return out

        return stage

    def stages(self) -> list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]]:
        return [
            ("quality_rules", self._stage(keep_good)),
            ("exact_dedup", self._stage(drop_copies)),
            ("near_dedup", self._stage(drop_near)),
            ("mixing", self._stage(take_copies)),
            ("packing", self._stage(packed, keeps=True)),
        ]


STAGES = Run().stages()

#: Near-dedup by signatures, Newton steps and best fit are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *stages, (_, last) = Run().stages()
    for name, stage in stages:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
