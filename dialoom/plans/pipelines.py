"""The stage chains: facts of dialogues to training sets, and questions to training sets, with one report each."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import interview, splits
from dialoom.operators.answers import continuation_rewrites, states_before
from dialoom.operators.dialogue import ordered_messages
from dialoom.operators.facts import distinct_facts, fact_errors, latest_turns, training_projection
from dialoom.operators.ledger import failure_ledger, turn_events
from dialoom.operators.prompts import interviewer_texts
from dialoom.operators.state import fold_states, turn_facts
from dialoom.operators.terms import standardized
from dialoom.session import table
from dialoom.sources.io import backup, finished, write_ledger, write_report, write_splits

log = logging.getLogger("dialoom")


def validated_facts(facts: DataFrame, turn_rows: DataFrame) -> DataFrame:
    """Distinct facts with ``errors`` and ``dialogue_ok``: whether no fact of the dialogue has one."""
    turns = latest_turns(turn_rows.select("dialogue_id", "turn_id", "patient_utterance", "processed_at")).drop("processed_at")
    rows = distinct_facts(facts).join(turns, ["dialogue_id", "turn_id"], "left").withColumn("errors", fact_errors())
    bad = rows.where(F.size("errors") > 0).select("dialogue_id").distinct().withColumn("bad", F.lit(True))
    return rows.join(bad, "dialogue_id", "left").withColumn("dialogue_ok", F.col("bad").isNull()).drop("bad", "patient_utterance")


def staged(spark: SparkSession, path: str, made: Callable[[], DataFrame], resume: bool) -> DataFrame:
    """A stage, written once and read by the next; with ``resume`` one that was written to the end isn't made again."""
    if not (resume and finished(spark, path)):
        made().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def extractor_pipeline(spark: SparkSession, tables: str, out: str, skip_failed: bool = True, resume: bool = False, run_dir: str | None = None) -> dict:
    """Validate, rewrite continuations, standardise, fold, project and split the facts; every stage is written once.

    ``run_dir``: where copies of earlier outputs go before they are written over. ``resume``: stages that an earlier
    run of the same inputs wrote to the end are read.
    """
    if run_dir and not resume:
        backup(spark, [f"{out}/{n}" for n in ("validated", "standardized", "states", "training_facts", "training", "failures")], run_dir)
    facts, turns = table(spark, tables, "facts"), table(spark, tables, "turn_rows")
    checked = staged(spark, f"{out}/validated", lambda: validated_facts(facts, turns), resume)
    kept = checked.where("dialogue_ok") if skip_failed else checked

    def coded_facts() -> DataFrame:
        rewritten = continuation_rewrites(kept.drop("errors", "dialogue_ok"), states_before(turns)).drop("rewritten")
        return standardized(rewritten, table(spark, tables, "terms"))

    coded = staged(spark, f"{out}/standardized", coded_facts, resume)
    states = staged(spark, f"{out}/states", lambda: fold_states(turn_facts(coded, turns)), resume)
    staged(spark, f"{out}/training_facts", lambda: training_projection(coded), resume)
    rows = splits.training_rows(turns.join(coded.select("dialogue_id").distinct(), "dialogue_id", "left_semi"), coded, ordered_messages(table(spark, tables, "messages")))
    if not (resume and finished(spark, f"{out}/training")):
        write_splits(rows, f"{out}/training")
    failed = write_ledger(failure_ledger(turn_events(turns), "dialogue_id"), f"{out}/failures")
    report = {
        "facts": checked.count(), "facts_with_errors": checked.where(F.size("errors") > 0).count(), "facts_kept": coded.count(), "coded": coded.where("standard_code is not null").count(),
        "states": states.count(), "training_rows": {r["split"]: r["count"] for r in spark.read.json(f"{out}/training").groupBy("split").count().collect()}, "failures": failed,
    }
    log.info("extractor pipeline: %s", report)
    return report


def interviewer_pipeline(spark: SparkSession, tables: str, out: str, resume: bool = False, run_dir: str | None = None) -> dict:
    """Check the decisions, drop dialogues with errors, write the training rows by split."""
    if run_dir and not resume:
        backup(spark, [f"{out}/checked", f"{out}/training"], run_dir)
    rows = table(spark, tables, "interviewer_rows")
    checked = staged(spark, f"{out}/checked", lambda: interview.decision_errors(interview.asked_before(interview.questions(rows))), resume)
    failed = checked.where(F.size("errors") > 0).select("source_dialogue_id").distinct()
    sound = checked.join(failed, "source_dialogue_id", "left_anti").where("usable")
    unknown = sound.where(F.coalesce(~F.col("split").isin(splits.SPLITS), F.lit(True))).limit(1).collect()
    if unknown:
        raise ValueError(f"no split: {unknown[0]['split']}")
    texts = interviewer_texts(rows).select("dialogue_id", "block_id", "input", "output")
    wanted = sound.select("dialogue_id", "block_id", "split").join(texts, ["dialogue_id", "block_id"])
    if not (resume and finished(spark, f"{out}/training")):
        write_splits(wanted.select("dialogue_id", "block_id", "split", F.lit("提出下一个问题").alias("instruction"), "input", "output"), f"{out}/training")
    report = {"rows": checked.count(), "rows_with_errors": checked.where(F.size("errors") > 0).count(), "failed_dialogues": failed.count(), "usable_rows": sound.count(), "split_overlaps": splits.overlapping(checked, "source_dialogue_id").count()}
    log.info("interviewer pipeline: %s", report)
    return report


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=["extractor", "interviewer"])
    parser.add_argument("tables")
    parser.add_argument("out")
    parser.add_argument("--report", help="where the report goes")
    parser.add_argument("--resume", action="store_true", help="read the stages that an earlier run finished")
    parser.add_argument("--run-dir", help="where copies of earlier outputs go")
    given = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    report = {"extractor": extractor_pipeline, "interviewer": interviewer_pipeline}[given.stage](spark, given.tables, given.out, resume=given.resume, run_dir=given.run_dir)
    if given.report:
        write_report(report, given.report)


if __name__ == "__main__":
    main()
