"""``spark-submit`` or ``python -m txnrisk``: run one stage or all over input files."""

import argparse
from dataclasses import replace

from txnrisk.functions import scoring
from txnrisk.plans import runs, session, stages
from txnrisk.sources.tables import FILE_FORMATS, Table
from txnrisk.sources.versions import Versioned

# Another name of the transform stage.
ALIASES = {"dbt": "transform"}


def _pair(text: str) -> tuple[str, str]:
    name, equals, value = text.partition("=")
    if not name or not equals:
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=VALUE")
    return name, value


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="txnrisk", description=__doc__)
    made.add_argument("--stage", choices=["all", *stages.STAGES, *ALIASES], default="all")
    made.add_argument("--data", help="folder of logs.json, payers.csv, payees.csv")
    made.add_argument("--root", required=True, help="folder of the stored layers")
    made.add_argument(
        "--logs", action="append", help="JSON lines; given several times, the first that exists"
    )
    made.add_argument("--payers", help="CSV file of the payers")
    made.add_argument("--payees", help="CSV file of the payees")
    made.add_argument("--csv-null", action="append", default=[], help="CSV text that means null")
    made.add_argument(
        "--layer",
        action="append",
        type=_pair,
        default=[],
        help="LAYER=FORMAT or LAYER=FORMAT:PATH, such as gold=orc or queue=jdbc:",
    )
    made.add_argument(
        "--option", action="append", type=_pair, default=[], help="LAYER.KEY=VALUE of a connector"
    )
    made.add_argument("--second-model", help="where the model goes if its first place fails")
    made.add_argument("--threshold", type=float, default=scoring.HIGH_RISK)
    made.add_argument("--accept", action="append", default=[], help="quality test that may fail")
    made.add_argument("--score-first", action="store_true", help="score gold if nothing waits")
    made.add_argument("--replace-queue", action="store_true")
    made.add_argument(
        "--resume", action="store_true", help="run only stages whose inputs or results have changed"
    )
    made.add_argument("--hash-width", type=int, help="codes of a category with too many values to list")
    made.add_argument("--batch", help="name of this run's alerts, appended once")
    return made


def layers_of(args: argparse.Namespace) -> stages.Layers:
    """The layers below the root, some in another format or place."""
    layers = stages.Layers.under(args.root, second_model=args.second_model)
    for name, text in args.layer:
        table = _layer(layers, name)
        kind, colon, path = text.partition(":")
        place = (path or None) if colon else table.path
        versions = place and kind in FILE_FORMATS
        made = Versioned(place, format=kind) if versions else Table(place, format=kind)
        layers = replace(layers, **{name: made})
    for name, value in args.option:
        layer, _, key = name.partition(".")
        table = _layer(layers, layer)
        options = {**table.options, key: value}
        layers = replace(layers, **{layer: replace(table, options=options)})
    return layers


def _layer(layers: stages.Layers, name: str) -> Table:
    table = getattr(layers, name, None)
    if not isinstance(table, Table):
        raise SystemExit(f"there is no layer {name!r}")
    return table


def settings_of(args: argparse.Namespace) -> stages.Settings:
    if not args.data and not args.logs:
        raise SystemExit("give --data or --logs")
    folder = args.data
    return stages.Settings(
        logs=tuple(args.logs or [f"{folder}/logs.json"]),
        payers=args.payers or (folder and f"{folder}/payers.csv"),
        payees=args.payees or (folder and f"{folder}/payees.csv"),
        csv_null_tokens=tuple(args.csv_null),
        accepted_failures=tuple(args.accept),
        threshold=args.threshold,
        score_first_when_none_wait=args.score_first,
        replace_queue=args.replace_queue,
        batch=args.batch,
        hash_width=args.hash_width,
    )


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    layers, settings = layers_of(args), settings_of(args)
    spark = session.builder().getOrCreate()
    stage = ALIASES.get(args.stage, args.stage)
    if args.resume:
        log = Versioned(f"{args.root}/runs")
        runs.plan_frame(spark, runs.plan(spark, layers, settings, log)).show(truncate=False)
        results = runs.run_stale(spark, layers, settings, log, None if stage == "all" else stage)
    else:
        names = stages.STAGES if stage == "all" else (stage,)
        results = stages.run(spark, layers, settings, names)
    for name, result in results.items():
        print(f"== {name}")
        result.show(truncate=False)


if __name__ == "__main__":
    main()
