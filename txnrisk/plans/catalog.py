"""Every operator as a query over the test tables: name -> (spark, folder) -> DataFrame.

The transactions come from ``sources.sample_views``. Metrics and queue queries
that need scores without a model use a stand-in: amount / 100000.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cache, cached_property, reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import scoring
from txnrisk.operators import (
    clean,
    confusion,
    curves,
    dictionary,
    enrich,
    extras,
    forest,
    medians,
    model,
    quality,
    queue,
    report,
    split,
)
from txnrisk.operators.joins import Limits
from txnrisk.plans import runs, stages
from txnrisk.plans.workdir import new_folder
from txnrisk.schemas import (
    CATEGORICAL_FEATURES,
    LABEL,
    NUMERIC_FEATURES,
    PAYEE_COLUMNS,
    PAYER_COLUMNS,
    QUEUE_COLUMNS,
    RAW_COLUMNS,
)
from txnrisk.sources import files, sample_views, segments
from txnrisk.sources.tables import Table, append_new, buckets_for, materialize
from txnrisk.sources.versions import Versioned

# A fixed run time, so that results can be compared.
QUARANTINED_AT = "TIMESTAMP_NTZ '2026-01-01 00:00:00'"
COUNTRIES = ["NATION_3", "NATION_19", "UNKNOWN"]
MIN_AMOUNT = 60000.0
DIGITS = 9
# Amounts as they arrive that are no numbers here.
ODD_AMOUNTS = ["n/a", "1,234.50", "12d", "1e999", "0x1p4"]
# JSON lines repeat their names, so a tenth of their bytes is stored, at the fastest level. One task reads such a file
# whole, hence the rows.
LINE_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 200_000}


class Views:
    """The layers over one folder of test tables, as lazy frames: plans, no stored rows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def raw(self) -> DataFrame:
        return sample_views.raw_transactions(self.spark, self.folder)

    @cached_property
    def payers(self) -> DataFrame:
        return sample_views.payers(self.spark, self.folder)

    @cached_property
    def payees(self) -> DataFrame:
        return sample_views.payees(self.spark, self.folder)

    @cached_property
    def silver(self) -> DataFrame:
        return clean.latest(self.raw)

    @cached_property
    def invalid(self) -> DataFrame:
        return clean.quarantine(self.raw, F.expr(QUARANTINED_AT))

    @cached_property
    def gold(self) -> DataFrame:
        # Keys are counted on silver: its one shuffle serves both, where raw rows would be joined a second time.
        return enrich.enrich(self.silver, self.payers, self.payees)

    @cached_property
    def scored(self) -> DataFrame:
        """Gold rows with an amount and the stand-in score."""
        return _with_scores(self.gold)

    @cached_property
    def alerts(self) -> DataFrame:
        return queue.alerts(report.unlabeled(self.scored))

    def totals(self) -> DataFrame:
        """Running totals over the scores' counts, which are stored as they are read twice."""
        return curves.running_totals(
            _stored(self, curves.score_counts(self.scored, "fraud_probability"))
        )

    @cached_property
    def lines(self) -> str:
        """The raw rows as JSON lines, written once: some are cut short, some followed by a blank one."""
        line, mcc = F.to_json(F.struct(*RAW_COLUMNS)), F.col("merchant_mcc")
        lines = self.raw.select(
            F.when(mcc % 50 == 7, F.substring(line, 1, 20))
            .when(mcc % 50 == 8, F.concat(line, F.lit("\n  \n")))
            .otherwise(line)
            .alias("value")
        )
        path = new_folder(self.spark, "lines")
        lines.write.options(**LINE_FILES).text(path)
        return path

    @cached_property
    def wide_lines(self) -> str:
        """The raw rows as JSON lines with further fields: nested, null, missing, of mixed types."""
        mcc, device = F.col("merchant_mcc"), F.col("device_id")
        further = F.concat_ws(
            "",
            F.when(mcc % 3 == 0, F.lit(',"channel":"web"')).when(mcc % 3 == 1, F.lit(',"channel":null')),
            F.when(
                mcc % 2 == 0,
                F.concat(
                    F.lit(',"geo":{"zone":'),
                    (mcc % 7).cast("string"),
                    F.lit(',"cell":{"id":"'),
                    device,
                    F.lit('"},"at":[1.50,true]}'),
                ),
            ),
            F.when(mcc % 5 == 0, F.concat(F.lit(',"retries":'), (mcc % 4).cast("string"))).when(
                mcc % 5 == 1, F.lit(',"retries":"n/a"')
            ),
        )
        line = F.to_json(F.struct(*RAW_COLUMNS))
        whole = F.concat(F.expr("substring(line, 1, length(line) - 1)"), "further", F.lit("}"))
        path = new_folder(self.spark, "wide-lines")
        lines = self.raw.select(line.alias("line"), further.alias("further"))
        lines.select(whole.alias("value")).write.options(**LINE_FILES).text(path)
        return path

    @cached_property
    def settings(self) -> stages.Settings:
        """Input files of the stages, written once."""
        inputs = new_folder(self.spark, "inputs")
        self.raw.write.options(**LINE_FILES).json(f"{inputs}/logs")
        self.payers.write.option("header", True).csv(f"{inputs}/payers")
        self.payees.write.option("header", True).csv(f"{inputs}/payees")
        return stages.Settings(
            (f"{inputs}/none", f"{inputs}/logs"),
            f"{inputs}/payers",
            f"{inputs}/payees",
            # The test tables hold rows with an id and no amount.
            accepted_failures=("not_null_enriched_transactions_amount",),
        )

    @cached_property
    def layers(self) -> stages.Layers:
        """The layers that the first two stages store, which no query changes."""
        layers = stages.Layers.under(new_folder(self.spark, "layers"))
        stages.run(self.spark, layers, self.settings, ("ingestion", "transform"))
        return layers

    def own_layers(self) -> stages.Layers:
        """The same layers with a model, metrics and queue that nothing else uses."""
        own = stages.Layers.under(new_folder(self.spark, "own"))
        kept = ("raw", "dim_payers", "dim_payees", "silver", "invalid", "gold")
        return replace(own, **{name: getattr(self.layers, name) for name in kept})

    @cached_property
    def trained(self) -> stages.Layers:
        """Layers with a fitted model, trained once."""
        layers = self.own_layers()
        stages.train(self.spark, layers, self.settings)
        return layers

    @cached_property
    def outcomes(self) -> DataFrame:
        return confusion.outcome_counts(self.scored, "prediction")


def _with_scores(rows: DataFrame) -> DataFrame:
    known = rows.filter(F.col("amount").isNotNull())
    return known.withColumn("fraud_probability", F.col("amount") / 100000).withColumn(
        "prediction", scoring.predicted()
    )


def _typed_rows(v: Views) -> DataFrame:
    """Raw rows turned to text, some of it unreadable, and parsed again."""
    mcc, amount = F.col("merchant_mcc"), F.col("amount").cast("string")
    text = v.raw.withColumns(
        {
            "timestamp": F.when(F.col("payment_method") == "5-LOW", "no time").otherwise(
                F.col("timestamp").cast("string")
            ),
            "amount": F.when(mcc % 7 == 0, "n/a").when(mcc % 7 == 1, "NaN").otherwise(amount),
            "merchant_mcc": F.when(mcc % 5 == 0, "code")
            .when(mcc % 5 == 1, F.concat(mcc.cast("string"), F.lit(".0")))
            .otherwise(mcc.cast("string")),
            "is_fraud": F.when(
                F.col("currency") == "USD",
                F.when(F.col(LABEL) == 1, "true").when(F.col(LABEL) == 0, "false"),
            ).otherwise(F.col(LABEL).cast("string")),
        }
    )
    parsed = clean.typed(text)
    return parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _odd_text(v: Views) -> DataFrame:
    """Raw rows as text: amounts in cents, and in every column but the ids some unreadable values."""
    mcc, label = F.col("merchant_mcc"), F.col(LABEL).cast("string")
    amount = F.round(F.col("amount") * 100).cast("bigint").cast("string")
    for place, odd in enumerate(ODD_AMOUNTS):
        amount = F.when(mcc % 9 == place, F.lit(odd)).otherwise(amount)
    return v.raw.withColumns(
        {
            "timestamp": F.when(F.col("payment_method") == "5-LOW", "no time").otherwise(
                F.col("timestamp").cast("string")
            ),
            "amount": amount,
            "merchant_mcc": F.when(mcc % 5 == 0, "code").otherwise(mcc.cast("string")),
            LABEL: F.when((F.col("currency") == "GBP") & (label == "1"), "maybe").otherwise(label),
        }
    )


def _quarantine_text(v: Views) -> DataFrame:
    """What arrived, of the rows without an id or with an amount that is no positive number."""
    broken = clean.quarantine(clean.with_state(_odd_text(v)))
    return broken.select("transaction_id", "amount", "merchant_mcc", LABEL, "quarantine_reason")


def _odd_amounts(v: Views) -> DataFrame:
    """Rows by amount, if it is an odd one, and record state."""
    amount = F.when(F.col("amount").isin(*ODD_AMOUNTS), F.col("amount")).alias("amount")
    rows = clean.with_state(_odd_text(v)).groupBy(amount, clean.STATE)
    return rows.agg(F.count("*").alias("n"))


def _labels_all(v: Views) -> DataFrame:
    """Rows per label where some rows have a label that is no class."""
    odd = F.when(F.col("merchant_mcc") % 9 == 0, F.lit(7)).otherwise(F.col(LABEL))
    return report.class_distribution(v.gold.withColumn(LABEL, odd.cast("bigint")))


def _json_ingest(v: Views) -> DataFrame:
    lines = files.read_lines(v.spark, v.lines)
    raw = clean.typed(files.readable(_stored(v, lines, clean.STATE)).select(RAW_COLUMNS))
    return raw.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _json_states(v: Views) -> DataFrame:
    lines = files.read_lines(v.spark, v.lines)
    return lines.groupBy(clean.STATE).agg(F.count("*").alias("n"))


def _csv(v: Views, frame: DataFrame, columns: list[str], tokens: tuple[str, ...]) -> DataFrame:
    path = new_folder(v.spark, "csv")
    # Columns are found by name, so their order in the file does not matter.
    frame.select(*reversed(columns)).write.option("header", True).csv(path)
    return files.read_lookup(v.spark, path, columns, tokens)


def _stored(v: Views, frame: DataFrame, partition_by: str | None = None) -> DataFrame:
    table = Table(new_folder(v.spark, "table"))
    table.replace(frame, partition_by)
    return table.read(v.spark)


def _stored_twice(v: Views, first: DataFrame, second: DataFrame) -> DataFrame:
    """Only the second write is left."""
    table = Table(new_folder(v.spark, "table"))
    table.replace(first)
    table.replace(second)
    return table.read(v.spark)


def _append_twice(v: Views) -> DataFrame:
    """The first append holds part of the alerts, the second all of them."""
    table, alerts = Table(new_folder(v.spark, "queue")), _stored(v, v.alerts)
    append_new(alerts.filter(F.col("payor_country") == "UNKNOWN"), table)
    append_new(alerts, table)
    return table.read(v.spark)


def _queue_replace(v: Views) -> DataFrame:
    """All unlabelled rows, then only the alerts among them. Both come from rows that are stored once."""
    waiting = _stored(v, report.unlabeled(v.gold))
    return _stored_twice(v, waiting, queue.alerts(_with_scores(waiting)))


def _append_repeats(v: Views) -> DataFrame:
    """A batch that holds every alert three times, one of them with another amount."""
    table, alerts = Table(new_folder(v.spark, "queue")), _stored(v, v.alerts)
    dearer = alerts.withColumn("amount", F.col("amount") + 1)
    append_new(alerts.unionByName(dearer).unionByName(alerts), table)
    return table.read(v.spark)


def _values(labeled: DataFrame) -> DataFrame:
    """The distinct values of each category: (feature, value)."""
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in CATEGORICAL_FEATURES
    ]
    return labeled.select(F.inline(F.array(*entries))).distinct()


def _coded(v: Views, steps: list, code: Callable[[str], Column], name: str) -> DataFrame:
    """What fitted steps make of each value of each category; only distinct values are coded."""
    labeled = _stored(v, report.labeled(v.gold).select(CATEGORICAL_FEATURES))
    values = _values(labeled)
    alone = values.select(
        "feature",
        "value",
        *[F.when(F.col("feature") == c, F.col("value")).alias(c) for c in CATEGORICAL_FEATURES],
    )
    coded = Pipeline(stages=steps).fit(labeled).transform(alone)
    codes = [F.when(F.col("feature") == c, code(c)) for c in CATEGORICAL_FEATURES]
    return coded.select("feature", "value", F.coalesce(*codes).alias(name))


def _category_index(v: Views) -> DataFrame:
    def place(name: str) -> Column:
        return F.col(f"{name}_index").cast("bigint")

    return _coded(v, [model.category_indexer()], place, "position")


def _one_hot(v: Views) -> DataFrame:
    """The one-hot vectors as text, such as 0,1,0."""

    def vector(name: str) -> Column:
        digits = F.transform(vector_to_array(F.col(f"{name}_hot")), lambda x: x.cast("int"))
        return F.concat_ws(",", digits.cast("array<string>"))

    return _coded(v, model.feature_stages()[:2], vector, "hot")


def _scaled_features(v: Views) -> DataFrame:
    """The numeric inputs as the forest sees them: each over its sample deviation."""
    rows = _stored(v, report.labeled(v.gold).filter(F.col("amount").isNotNull()))
    scaled = Pipeline(stages=model.feature_stages()).fit(rows).transform(rows)
    values = vector_to_array(F.col("features"))
    numbers = [
        F.round(F.element_at(values, i - len(NUMERIC_FEATURES)), 6).alias(name)
        for i, name in enumerate(NUMERIC_FEATURES)
    ]
    return scaled.select("transaction_id", *numbers)


def _fraud_probability(v: Views) -> DataFrame:
    """Probabilities out of vectors, of which some are missing and some too short."""
    p, kind = F.col("fraud_probability"), F.col("merchant_mcc") % 11
    values = F.when(kind == 1, F.array(p)).otherwise(F.array(1 - p, p))
    vector = F.when(kind != 0, array_to_vector(values))
    scores = v.scored.select("transaction_id", vector.alias("probability"))
    value = scoring.fraud_probability().alias("fraud_probability")
    return scores.select("transaction_id", value)


def _split_rows(v: Views) -> DataFrame:
    """Rows that training and testing get, by label."""
    labeled = _stored(v, report.labeled(v.gold).select("transaction_id", LABEL))
    return split.stratified_split(labeled).groupBy(LABEL, "split").agg(F.count("*").alias("n"))


def _accuracy(v: Views) -> DataFrame:
    return confusion.accuracy(v.outcomes).select(F.round("accuracy", DIGITS).alias("accuracy"))


def _area(v: Views, name: str) -> DataFrame:
    return curves.area_metrics(v.totals()).select(F.round(name, DIGITS).alias(name))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


def _random_split(v: Views) -> DataFrame:
    """Rows per class of both parts, which read the rows where they are stored once."""
    train, test = split.random_split(_stored(v, report.labeled(v.gold).select("transaction_id", LABEL)))
    both = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
    return both.groupBy("split", LABEL).agg(F.count("*").alias("n"))


def _stage_counts(v: Views) -> DataFrame:
    layers = v.layers
    return report.layer_counts(
        {
            "raw": stages.read_raw(v.spark, layers),
            "staging": layers.silver.read(v.spark),
            "quarantine": layers.invalid.read(v.spark),
            "gold": stages.read_gold(v.spark, layers),
        }
    )


def _train_eval(v: Views) -> DataFrame:
    return stages.train(v.spark, v.own_layers(), v.settings)


def _score_unlabeled(v: Views) -> DataFrame:
    fitted = stages.load_or_train(v.spark, v.trained, v.settings)
    scored = model.score(fitted, stages.unlabeled_gold(v.spark, v.trained))
    return scored.select("transaction_id", "fraud_probability", "prediction")


def _review_queue(v: Views) -> DataFrame:
    layers = replace(v.own_layers(), model=v.trained.model)
    stages.infer(v.spark, layers, v.settings)
    return layers.queue.read(v.spark)


def _score_checks(v: Views) -> DataFrame:
    """Whether each unlabelled row has a probability, and the prediction that follows from it."""
    p, prediction = F.col("fraud_probability"), F.col("prediction")
    return _score_unlabeled(v).select(
        "transaction_id",
        ((p >= 0) & (p <= 1)).alias("is_probability"),
        (prediction == F.when(p >= 0.5, 1.0).otherwise(0.0)).alias("follows"),
    )


def _queue_checks(v: Views) -> DataFrame:
    """Whether each unlabelled row is queued as often as it should be, as it is in gold.

    That is once for a probability of 0.5 and up, with label and prediction 1,
    and never below.
    """
    kept = [c for c in QUEUE_COLUMNS if c not in (LABEL, "prediction")]
    queued = _review_queue(v).filter((F.col(LABEL) == 1) & (F.col("prediction") == 1.0))
    times = queued.groupBy(kept).agg(F.count("*").alias("times"))
    gold = stages.unlabeled_gold(v.spark, v.layers)
    same = reduce(Column.__and__, [gold[c].eqNullSafe(times[c]) for c in kept])
    scores = _score_unlabeled(v).withColumnRenamed("transaction_id", "scored_id")
    expected = F.when(F.col("fraud_probability") >= 0.5, 1).otherwise(0)
    return (
        gold.join(times, same, "left")
        .join(scores, gold["transaction_id"] == F.col("scored_id"))
        .select(gold["transaction_id"], (F.coalesce("times", F.lit(0)) == expected).alias("right"))
    )


def _extra_fields(v: Views) -> DataFrame:
    """Which further fields the stored raw layer holds, of which types, and a digest of their values."""
    layers = stages.Layers.under(new_folder(v.spark, "wide"))
    stages.ingest(v.spark, layers, stages.Settings(v.wide_lines))
    return extras.census(stages.read_further(v.spark, layers), files.EXTRA, "transaction_id")


def _inputs_missing(v: Views) -> DataFrame:
    """Rows of inputs that are there, missing or empty."""
    empty, there = new_folder(v.spark, "empty"), v.settings
    v.spark.createDataFrame([], "value string").write.text(empty)
    frames = {
        "empty_log": _stored(v, files.read_lines(v.spark, empty)),
        "log": _stored(v, files.read_lines(v.spark, there.logs[1])),
        "missing_payers": files.read_lookup(v.spark, f"{there.payers}-none", PAYER_COLUMNS),
        "no_payers": files.read_lookup(v.spark, None, PAYER_COLUMNS),
        "payees": files.read_lookup(v.spark, there.payees, PAYEE_COLUMNS),
    }
    counts = [
        frame.agg(F.lit(name).alias("input"), F.count("*").alias("rows")) for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _enriched_without_payers(v: Views) -> DataFrame:
    missing = files.read_lookup(v.spark, f"{v.settings.payers}-none", PAYER_COLUMNS)
    return enrich.enrich(v.silver, missing, v.payees)


def _forest_table(v: Views) -> DataFrame:
    return forest.nodes(v.spark, v.trained.model)


def _forest_rescored(v: Views) -> DataFrame:
    """Whether a walk of the stored nodes gives the model's own probability, for each unlabelled row."""
    fitted = stages.load_or_train(v.spark, v.trained, v.settings)
    scored = fitted.transform(stages.unlabeled_gold(v.spark, v.trained))
    own = forest.probability(vector_to_array("features"), _forest_table(v))
    same = F.abs(own - scoring.fraud_probability()) <= 1e-9
    return scored.select("transaction_id", same.alias("same"))


def _forest_shape(v: Views) -> DataFrame:
    shape = forest.shape(_forest_table(v))
    return shape.select(
        F.col("tree").cast("bigint").alias("tree"),
        "complete",
        "rows_add_up",
        (F.col("depth") <= model.DEPTH).alias("within_depth"),
        (F.col("nodes") > 1).alias("splits"),
    )


def _table_versions(v: Views) -> DataFrame:
    """The rows of each version of a table that is written, appended to, replaced and compacted."""
    table, gold = Versioned(new_folder(v.spark, "versions")), _stored(v, v.gold)
    table.replace(report.labeled(gold), "payment_method")
    table.append(report.unlabeled(gold), "unlabeled")
    table.append(report.unlabeled(gold), "unlabeled")
    table.replace(table.read(v.spark, gold.schema).filter(F.col("payor_country") == "UNKNOWN"))
    return table.history(v.spark, gold.schema).select("version", "transaction_id", "amount", "payment_method")


def _append_pruned(v: Views) -> DataFrame:
    """The queue after each of two appends; the second holds all alerts, a third repeats its batch."""
    queued, alerts = Versioned(new_folder(v.spark, "queue")), _stored(v, v.alerts)
    append_new(alerts.filter(F.col("payor_country") == "UNKNOWN"), queued, "first")
    append_new(alerts, queued, "second")
    append_new(alerts, queued, "second")
    return queued.history(v.spark, alerts.schema).select("version", "transaction_id", "amount")


def _connector_round_trip(v: Views) -> DataFrame:
    """Gold through a connector without a path: written in two parts, read back."""
    segments.register(v.spark)
    table = Table(format=segments.FORMAT, options={"table": new_folder(v.spark, "segments")})
    gold = _stored(v, v.gold)
    table.replace(v.spark.range(3))
    table.replace(report.labeled(gold))
    table.append(report.unlabeled(gold))
    return table.read(v.spark)


def _exact_medians(v: Views) -> DataFrame:
    """Medians of the model's numeric inputs over all labelled rows and over all but one, odd and even."""
    rows = _stored(v, report.labeled(v.gold).select("transaction_id", *NUMERIC_FEATURES))
    first = rows.agg(F.min("transaction_id").alias("id")).scalar()
    parts = {"all": rows, "all_but_one": rows.filter(F.col("transaction_id") != first)}
    found = [
        medians.table(frame, NUMERIC_FEATURES).withColumn("part", F.lit(name)) for name, frame in parts.items()
    ]
    return _rounded(reduce(DataFrame.unionByName, found), "median")


def _category_ranks(v: Views) -> DataFrame:
    """Devices by frequency, from a dictionary that stays distributed."""
    return dictionary.ranks(v.gold, "device_id")


def _category_codes(v: Views) -> DataFrame:
    """Rows of each code that the dictionary of labelled devices gives all rows; none for the others."""
    gold = _stored(v, v.gold.select("transaction_id", "payor_id", LABEL))
    known = dictionary.ranks(report.labeled(gold), "payor_id")
    coded = dictionary.encoded(gold, "payor_id", known, "transaction_id", Limits(0, 50, 100))
    return coded.groupBy("payor_id_position").agg(F.count("*").alias("n"))


def _enriched_bucketed(v: Views) -> DataFrame:
    """Gold from a raw table that is stored by the hash of its ids."""
    name = f"raw_{uuid.uuid4().hex}"
    # One transaction per line item at most: their number comes from the file's footer.
    buckets = buckets_for(sample_views.table(v.spark, v.folder, "lineitem").count())
    place = {"path": new_folder(v.spark, name)}
    raw = Table(name=name, options=place, bucket_by="transaction_id", buckets=buckets)
    raw.replace(v.raw)
    rows = raw.read(v.spark)
    return enrich.enrich(clean.latest(rows), v.payers, v.payees, keys_from=rows)


def _stored_counts(v: Views) -> DataFrame:
    """Rows of the stored layers, from the files' footers."""
    layers = v.layers
    named = {"staging": layers.silver, "quarantine": layers.invalid, "gold": layers.gold}
    folders = {name: table.folders(v.spark) for name, table in named.items()}
    return report.stored_counts(v.spark, folders)


def _stage_plan(v: Views) -> DataFrame:
    """Which stages are left after a run of two, and after one of the layers has been replaced."""
    layers = stages.Layers.under(new_folder(v.spark, "planned"))
    log = Versioned(new_folder(v.spark, "runs"))
    runs.run_stale(v.spark, layers, v.settings, log, until="transform")
    two = runs.plan_frame(v.spark, runs.plan(v.spark, layers, v.settings, log))
    again = runs.run_stale(v.spark, layers, v.settings, log, until="transform")
    layers.dim_payers.replace(layers.dim_payers.read(v.spark).filter("payor_country IS NOT NULL"))
    changed = runs.plan_frame(v.spark, runs.plan(v.spark, layers, v.settings, log))
    both = two.withColumn("after", F.lit("two stages")).unionByName(
        changed.withColumn("after", F.lit("a change"))
    )
    return both.withColumn("ran_again", F.lit(len(again)).cast("bigint"))


QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    # Sources and sinks.
    "raw_scan": lambda v: v.raw,
    "dim_payers": lambda v: v.payers,
    "dim_payees": lambda v: v.payees,
    "typed_rows": _typed_rows,
    "quarantine_text": _quarantine_text,
    "parse_losses": lambda v: clean.parse_losses(_odd_text(v)),
    "odd_amounts": _odd_amounts,
    "labels_all": _labels_all,
    "json_ingest": _json_ingest,
    "json_line_states": _json_states,
    "csv_payers": lambda v: _csv(v, v.payers, PAYER_COLUMNS, ()),
    "csv_payees": lambda v: _csv(v, v.payees, PAYEE_COLUMNS, ("Travel",)),
    "table_overwrite": lambda v: _stored(v, v.gold),
    "table_by_state": lambda v: clean.with_valid_id(
        _stored(v, clean.with_state(v.raw), clean.STATE)
    ).select(RAW_COLUMNS),
    "silver_view": lambda v: materialize(v.silver, "silver_view"),
    "extra_fields": _extra_fields,
    "inputs_missing": _inputs_missing,
    "table_versions": _table_versions,
    "connector_round_trip": _connector_round_trip,
    # Cleaning.
    "valid_id_rows": lambda v: clean.with_valid_id(v.raw),
    "ranked_rows": lambda v: clean.ranked(clean.with_valid_id(v.raw), keep=3),
    "stg_dedup_latest": lambda v: v.silver,
    "quarantine": lambda v: v.invalid,
    "quarantine_by_reason": lambda v: v.invalid.groupBy("quarantine_reason").agg(
        F.count("*").alias("n")
    ),
    # Enrichment.
    "payer_lookup": lambda v: enrich.payer_lookup(v.payers),
    "payee_lookup": lambda v: enrich.payee_lookup(v.payees),
    "enriched": lambda v: v.gold,
    "enriched_by_shuffle": lambda v: enrich.enrich(
        v.silver, v.payers, v.payees, Limits(broadcast_bytes=0, smallest_share=100)
    ),
    "enriched_without_payers": _enriched_without_payers,
    "enriched_bucketed": _enriched_bucketed,
    # Quality tests.
    "dup_count": lambda v: quality.surplus_rows(v.raw, "transaction_id"),
    "null_id_count": lambda v: quality.null_rows(v.raw, "transaction_id"),
    "dq_report": lambda v: quality.quality_report(v.silver, v.gold),
    "dq_raw_keys": lambda v: quality.key_tests(
        v.raw, "raw_transactions", "transaction_id", ["transaction_id", "amount"]
    ),
    "dq_lookups": lambda v: quality.lookup_report(v.payers, v.payees),
    # Counts, filters, samples.
    "raw_count": lambda v: report.row_count(v.raw),
    "layer_counts": lambda v: report.layer_counts(
        {
            "raw": v.raw,
            "staging": v.silver,
            "quarantine": v.invalid,
            "gold": v.gold,
            "queue": v.alerts,
        }
    ),
    "ingestion_summary": lambda v: report.ingestion_summary(v.raw),
    "class_distribution": lambda v: report.class_distribution(v.gold),
    "labeled_rows": lambda v: report.labeled(v.gold),
    "unlabeled_rows": lambda v: report.unlabeled(v.gold),
    # Read twice, so stored once.
    "unlabeled_or_first_2500": lambda v: report.unlabeled_or_first(_stored(v, report.labeled(v.gold))),
    "layer_sample_raw": lambda v: report.layer_sample(v.raw),
    "layer_sample_stg": lambda v: report.layer_sample(v.silver),
    "layer_sample_invalid": lambda v: report.layer_sample(v.invalid),
    "layer_sample_gold": lambda v: report.layer_sample(stages.read_gold(v.spark, v.layers)),
    "layer_sample_payers": lambda v: report.layer_sample(v.payers),
    "layer_sample_payees": lambda v: report.layer_sample(v.payees),
    # Review queue.
    "proxy_scores": lambda v: v.scored.select(
        "transaction_id", "fraud_probability", "prediction"
    ),
    "proxy_alerts": lambda v: v.alerts,
    "queue_existing_columns": lambda v: queue.existing(v.silver, QUEUE_COLUMNS),
    "queue_append_twice": _append_twice,
    "queue_append_repeats": _append_repeats,
    "queue_append_pruned": _append_pruned,
    "queue_replace": _queue_replace,
    "queue_filter": lambda v: report.filter_queue(v.alerts, COUNTRIES, MIN_AMOUNT),
    "queue_formatted": lambda v: report.formatted_queue(v.alerts),
    "alert_sample": lambda v: report.alert_sample(v.alerts),
    "alerts_by_country": lambda v: report.alerts_by_country(v.alerts),
    "alerts_by_method": lambda v: _rounded(report.alerts_by_method(v.alerts), "share"),
    "country_options": lambda v: report.country_options(v.alerts),
    # Model inputs and metrics.
    "feature_frame": lambda v: model.feature_frame(v.gold),
    "category_index": _category_index,
    "category_ranks": _category_ranks,
    "category_codes": _category_codes,
    "exact_medians": _exact_medians,
    "stratified_split": lambda v: split.stratified_split(
        _stored(v, report.labeled(v.gold).select("transaction_id", LABEL))
    ),
    "random_split": _random_split,
    "split_rows": _split_rows,
    "one_hot": _one_hot,
    "scaled_features": _scaled_features,
    "fraud_probability": _fraud_probability,
    "roc_auc": lambda v: _area(v, "roc_auc"),
    "avg_precision": lambda v: _area(v, "average_precision"),
    "pr_auc": lambda v: _area(v, "pr_auc"),
    "accuracy": _accuracy,
    "classification_report": lambda v: _rounded(
        confusion.classification_report(v.outcomes), "precision", "recall", "f1_score"
    ),
    "roc_curve": lambda v: _rounded(curves.roc_curve(v.totals()), "fpr", "tpr", "threshold"),
    # The stages over stored layers.
    "stage_counts": _stage_counts,
    "stored_counts": _stored_counts,
    "stage_plan": _stage_plan,
    "train_eval": _train_eval,
    "score_unlabeled": _score_unlabeled,
    "review_queue": _review_queue,
    "score_checks": _score_checks,
    "queue_checks": _queue_checks,
    "forest_rescored": _forest_rescored,
    "forest_shape": _forest_shape,
}


@cache
def views(application: str, spark: SparkSession, folder: str) -> Views:
    """The views of a folder, defined once per application."""
    return Views(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(
            views(spark.sparkContext.applicationId, spark, folder)
        )

    return {name: bound(build) for name, build in QUERIES.items()}


def fraud_by_country(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions known to be fraud, per payer country."""
    return report.alerts_by_country(Views(spark, folder).gold.filter(F.col(LABEL) == 1))
