"""Command line: python -m barweave <step> ... (see README)."""

import argparse

from pyspark.sql import SparkSession

from barweave.plans import keyed_models, programs
from barweave.sources import messages
from barweave.streaming import sinks


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="barweave")
    steps = parser.add_subparsers(dest="step", required=True)

    p = steps.add_parser("preprocess", help="bar files to a feature table")
    p.add_argument("inputs", nargs="+", metavar="SYMBOL=PATH")
    p.add_argument("--out", required=True)
    p.add_argument("--scaler")
    p.add_argument("--fit-on", choices=["train", "all"], default="train")
    p.add_argument("--scaled", action="store_true")

    p = steps.add_parser("train", help="models, result tables and metrics per symbol")
    p.add_argument("--table", required=True)
    p.add_argument("--models", required=True)
    p.add_argument("--reports", required=True)
    p.add_argument("--names", default="lr,rf,gbt")
    p.add_argument("--symbols")
    p.add_argument("--together", action="store_true", help="all symbols in the same jobs (lr, rf, xgb)")
    p.add_argument("--set", action="append", default=[], metavar="MODEL.OPTION=NUMBER")

    p = steps.add_parser("evaluate", help="compare stored models on test rows")
    p.add_argument("--table", required=True)
    p.add_argument("--models", required=True)
    p.add_argument("--symbol", required=True)
    p.add_argument("--names", default="lr,rf,gbt")

    p = steps.add_parser("publish", help="rows as JSON messages")
    p.add_argument("--table", required=True)
    p.add_argument("--symbol", help="all symbols without it; messages then name theirs")
    p.add_argument("--typed", action="store_true")
    _target(p)

    p = steps.add_parser("score", help="score a message stream")
    p.add_argument("--models", required=True)
    p.add_argument("--symbol", help="without it, messages name theirs and models are those trained together")
    p.add_argument("--names", default="lr,rf,gbt")
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--starting", choices=["latest", "earliest"], default="latest")
    p.add_argument("--every", help="trigger interval, such as '1 second'")
    p.add_argument("--flags", action="store_true", help="add whether each model was right")
    p.add_argument("--drain", action="store_true", help="read what is there and stop")
    p.add_argument("--scaler", help="bounds stored by preprocess, for models of scaled rows")
    p.add_argument("--limit", type=int, help="messages (topic) or files (folder) per trigger")
    _target(p)
    return parser.parse_args()


def settings(items: list[str]) -> dict[str, dict[str, float]]:
    """['rf.trees=300'] to {'rf': {'trees': 300}}."""
    found: dict[str, dict[str, float]] = {}
    for item in items:
        place, value = item.split("=", 1)
        model, option = place.split(".", 1)
        number = float(value)
        found.setdefault(model, {})[option] = int(number) if number.is_integer() else number
    return found


def _target(p: argparse.ArgumentParser) -> None:
    p.add_argument("--folder")
    p.add_argument("--servers")
    p.add_argument("--topic")


def main() -> None:
    a = arguments()
    spark = SparkSession.builder.appName(f"barweave {a.step}").getOrCreate()
    names = a.names.split(",") if "names" in a else []
    if a.step == "preprocess":
        paths = dict(item.split("=", 1) for item in a.inputs)
        programs.preprocess(
            spark, paths, a.out, scaler=a.scaler, fit_on=a.fit_on, scaled=a.scaled
        )
    elif a.step == "train":
        symbols = a.symbols.split(",") if a.symbols else None
        if a.together:
            table = programs.read_table(spark, a.table)
            if symbols:
                table = table.where(table.symbol.isin(symbols))
            predictions = keyed_models.train(table, a.models, names, settings(a.set))
        else:
            predictions = programs.train(
                spark, a.table, a.models, names, symbols, settings(a.set)
            )
        programs.report(predictions, a.reports).show(truncate=False)
    elif a.step == "evaluate":
        programs.evaluate_stored(spark, a.table, a.models, a.symbol, names).show(truncate=False)
    elif a.step == "publish":
        programs.publish(
            spark, a.table, a.symbol,
            folder=a.folder, servers=a.servers, topic=a.topic, typed=a.typed,
        )
    else:
        if a.folder:
            stream = messages.folder_stream(spark, a.folder, a.limit)
        else:
            options = messages.kafka_options(
                a.servers, a.topic, starting=a.starting, max_per_trigger=a.limit
            )
            stream = messages.topic_stream(spark, options)
        when = sinks.trigger(a.every, drain=a.drain)
        options = {"flags": a.flags, "scaler": a.scaler, **when}
        if a.symbol is None:
            query = keyed_models.score_stream(
                stream, a.models, names, a.out, a.checkpoint, **options
            )
        else:
            query = programs.score_stream(
                stream, a.models, a.symbol, names, a.out, a.checkpoint, **options
            )
        sinks.drained(query)


if __name__ == "__main__":
    main()
