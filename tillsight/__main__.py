"""Jobs from the command line, for ``spark-submit`` or ``python -m tillsight``.

Topics are Kafka topics if ``--kafka`` names servers, else folders under
``--folder``.
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession

from tillsight.operators import model
from tillsight.operators.insights import FRAUD_INSIGHTS, SALES_INSIGHTS
from tillsight.operators.latest import read_insight
from tillsight.operators.shaping import series_json
from tillsight.plans import jobs
from tillsight.sinks.publish import publish_transactions
from tillsight.sources.csv_files import read_csv
from tillsight.sources.topics import FileTopics, KafkaTopics
from tillsight.streaming.insight_streams import STATE_PARTITIONS, start_decode, start_detail, start_insights


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tillsight", description=__doc__)
    where = top.add_mutually_exclusive_group(required=True)
    where.add_argument("--kafka", metavar="SERVERS")
    where.add_argument("--folder")
    top.add_argument("--from", dest="start", help="first offsets of a batch read, or first time of a folder's")
    top.add_argument("--to", dest="end", help="last offsets, or the time before which messages came")
    commands = top.add_subparsers(dest="command", required=True)

    publish = commands.add_parser("publish", help="CSV records to the transactions topic")
    publish.add_argument("csv")
    sales = commands.add_parser("sales", help="sales insights to their topics")
    sales.add_argument("--income", action="store_true", help="average spending per income too")
    fraud = commands.add_parser("fraud", help="fraud insights to their topics, and on the console")
    fraud.add_argument("--rows", type=int, default=20, help="rows of each table to show")
    for insights in (sales, fraud):
        insights.add_argument("--covered", metavar="PATH", help="read new messages only; what is covered is kept there")
    detail = commands.add_parser("detail", help="latest message per id to a Parquet table; with --from, added to it")
    detail.add_argument("path")
    train = commands.add_parser("train", help="fit, save and evaluate the fraud model")
    train.add_argument("path")
    train.add_argument("--unseen", choices=["keep", "skip", "error"], default="keep")
    train.add_argument("--missing", choices=["drop", "keep"], default="drop")
    train.add_argument("--random-split", type=int, metavar="SEED", help="split by a seeded draw")
    chart = commands.add_parser("series", help="an insight's latest table as chart arrays")
    chart.add_argument("name")
    follow = commands.add_parser("stream", help="keep insights up to date")
    follow.add_argument("names", nargs="+", metavar="name", help="insights, or 'records' or 'detail' alone")
    follow.add_argument("--max-per-trigger", type=int, help="offsets, or files of a folder, at a time")
    follow.add_argument("--state-partitions", type=int, default=STATE_PARTITIONS)
    follow.add_argument("--path", help="where records or the detail table go; refused messages go beside it")
    follow.add_argument("--checkpoint", required=True)
    follow.add_argument("--available-now", action="store_true", help="stop when caught up")
    return top


def run(spark: SparkSession, options) -> None:
    if options.kafka:
        topics = KafkaTopics(
            options.kafka, starting_offsets=options.start or "earliest", ending_offsets=options.end or "latest"
        )
    else:
        topics = FileTopics(options.folder, options.start, options.end)
    match options.command:
        case "publish":
            publish_transactions(read_csv(spark, options.csv), topics)
        case "sales":
            names = (*SALES_INSIGHTS, "income") if options.income else SALES_INSIGHTS
            for name, table in _insights(spark, topics, names, options.covered).items():
                print(f"{name}: {table.count()} groups sent")
        case "fraud":
            jobs.show(_insights(spark, topics, FRAUD_INSIGHTS, options.covered), options.rows)
        case "detail":
            load = jobs.detail_job(spark, topics, options.path)
            print(
                f"{load.rows_read} read, {load.stored} stored, {load.replaced} replaced, "
                f"{load.refused} refused"
            )
        case "train":
            split = model.stable_split
            if options.random_split is not None:
                split = partial(model.random_split, seed=options.random_split)
            trained = jobs.training_job(
                spark, topics, options.path, split, options.unseen, options.missing
            )
            trained.area.show()
            print(f"{trained.rows_read} rows read, {trained.left_out} left out")
        case "series":
            table = read_insight(spark, topics, options.name, latest=True)
            for document in series_json(table, options.name).toLocalIterator():
                print(document.value)
        case "stream":
            limits = {
                "max_per_trigger": options.max_per_trigger, "available_now": options.available_now
            }
            if options.names == ["records"]:
                refused = f"{options.path}-refused"
                query = start_decode(spark, topics, options.path, options.checkpoint, **limits, refused_path=refused)
            elif options.names == ["detail"]:
                query = start_detail(spark, topics, options.path, options.checkpoint, **limits)
            else:
                query = start_insights(
                    spark, topics, topics, options.names, options.checkpoint,
                    state_partitions=options.state_partitions, **limits,
                )
            query.awaitTermination()


def _insights(spark, topics, names, covered):
    if covered:
        return jobs.increment_job(spark, topics, topics, covered, names)
    return jobs.insight_job(spark, topics, topics, names)


if __name__ == "__main__":
    run(SparkSession.builder.appName("tillsight").getOrCreate(), parser().parse_args())
