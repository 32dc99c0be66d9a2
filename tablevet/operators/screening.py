"""Row cleaning, column dropping and the ordered integrity gates for a whole fleet in one job.

Shuffles: 64 bits of each row's fingerprint (which rows may have copies), fingerprints of those, 64 bits of
each value of columns that may be identifiers, then per column and per dataset results. These hashes are
dealt to tasks of a fixed size, whose number follows the rows, and are not gathered in memory before. A feature is an
identifier when no two different rows share a value; most columns that are none show it by a few of
their values, so the others are not counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablevet.functions.values import NUMERIC_DTYPES, STORE_TYPES, value_key
from tablevet.limits import Limits
from tablevet.operators.profile import catalog_task, names_where, of_target, share
from tablevet.session import staged
from tablevet.sources.fleet import KEY, Fleet, dataset_code, numbered, target_value_present, with_fingerprint

OUTCOME = [*KEY, "status", "reason"]


def drop_missing_target(fleet: Fleet) -> Fleet:
    """Keep the rows whose target is present."""
    return Fleet(fleet.rows.where(target_value_present()), fleet.columns)


def dedup_rows(fleet: Fleet) -> Fleet:
    """Keep one row of each kind, the first by ``row_id``; NULL equals NULL."""
    return Fleet(with_fingerprint(distinct_rows(fleet.rows).drop("copies")), fleet.columns)


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Different rows and their number of copies; copies are folded before the shuffle."""
    return rows.groupBy(*KEY, "target_store", "target_slot", *STORE_TYPES).agg(
        F.min("row_id").alias("row_id"), F.count("*").alias("copies")
    )


# One in this many values of a column, and rows of a dataset, are looked up for copies before all of them are.
PROBED, PROBED_ROWS = 256, 1024


# Numbers beside those of columns: of all rows, and of the target.
OF_ROWS, OF_TARGET = -1, -2


# Repeated hashes are noted by this many buckets.
BUCKETS = 1 << 14
# Hashes in a task that compares them.
TASK_HASHES = 2_000_000


def bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def dealt(hashed: DataFrame, by: list[str], count: int) -> DataFrame:
    """About ``count`` rows dealt by hashes to as many tasks as keep each within ``TASK_HASHES``. They are
    sent as they are read: folding or sorting them before would fill a task's memory and spill, as hardly
    any are equal."""
    return hashed.repartition(max(1, -(-count // TASK_HASHES)), *by)


def repeats(hashed: DataFrame, by: list[str], count: int) -> DataFrame:
    """For each group ``by`` the buckets (``_buckets``) in which a number ``_hash`` occurs twice, missing if
    it is many of them; groups without any are left out. There are about ``count`` rows.

    Equal things agree in the number, different ones seldom do, so what is not in these buckets is there
    once, and only what is has to be compared in full.
    """
    twice = dealt(hashed, [*by, "_hash"], count).groupBy(*by, "_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    found = (
        twice.select(*by, bucket(F.col("_hash")).alias("_bucket")).distinct().groupBy(*by)
        .agg(F.collect_list("_bucket").alias("_buckets"))
    )
    return found.withColumn("_buckets", F.when(F.size("_buckets") <= BUCKETS // 16, F.col("_buckets")))


def total(counted: DataFrame, column: str) -> int:
    return counted.agg(F.sum(column)).first()[0] or 0


def in_buckets(place: Column) -> Column:
    return F.col("_buckets").isNull() | F.array_contains("_buckets", place)


def maybe_copied(rows: DataFrame, probed: DataFrame, count: int | None = None) -> DataFrame:
    """Datasets (collection_id, dataset_id) that may have copies of rows with a target, and the buckets
    these are in. ``probed`` tells the datasets whose probed rows have copies (``_copied``), which count
    as a whole; of the others 64 bits of each row are moved. ``count`` is their number of rows, counted if
    it is not given."""
    whole = probed.where("_copied").select(*KEY, F.lit(None).cast("array<int>").alias("_buckets"))
    rest = probed.where("NOT _copied")
    hashed = (
        with_target_key(of_datasets(rows, rest))
        .select(*KEY, F.col("fingerprint.b").alias("_hash"))
        .join(rest.select(*KEY), KEY, "left_semi")
        .select(dataset_code(), "_hash")
    )
    named = rest.select(*KEY, dataset_code())
    count = hashed.count() if count is None else count
    return whole.unionByName(repeats(hashed, ["_of"], count).join(named, "_of").select(*KEY, "_buckets"))


def row_facts(rows: DataFrame, copied: DataFrame, count: int) -> DataFrame:
    """Facts of rows that have a target, by dataset code and number: copies beyond the first, as negative
    counts, of whole rows (``OF_ROWS``) and of the missing values of each column, and the classes of the
    different rows (``OF_TARGET``). The datasets in ``copied`` have about ``count`` rows.

    Only rows of the buckets in ``copied`` are told apart, by their fingerprint, target and places of
    missing values, and none is moved with its values.
    """
    hashes, kind = ["_a", "_b"], ["_of", "_gaps", "_target"]
    meant = (
        with_target_key(of_datasets(rows, copied))
        .select(
            *KEY,
            F.col("fingerprint.a").alias("_a"),
            F.col("fingerprint.b").alias("_b"),
            F.coalesce("fingerprint.gaps", F.lit("")).alias("_gaps"),
            F.col("fingerprint.target").alias("_target"),
        )
        .join(copied, KEY)
        .where(in_buckets(bucket(F.col("_b"))))
        .select(dataset_code(), "_gaps", "_target", *hashes)
    )
    extra = (
        dealt(meant, hashes, count)
        .groupBy(*hashes, *kind)
        .agg((1 - F.count(F.lit(1))).alias("_n"))
        .where("_n < 0")
        .groupBy(*kind)
        .agg(F.sum("_n").alias("_n"))
    )
    none = F.lit(None).cast("string")
    sides = F.array(
        F.struct(F.col("_gaps").alias("_gap"), none.alias("_class")),
        F.struct(none.alias("_gap"), F.col("_target").alias("_class")),
    )
    classes = (
        rows.where(target_value_present())
        .groupBy(dataset_code(), F.col("fingerprint.target").alias("_class"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_of", none.alias("_gap"), "_class", "_n")
    )
    folded = (
        extra.select("_of", F.inline(sides), "_n")
        .unionByName(classes)
        .groupBy("_of", "_gap", "_class")
        .agg(F.sum("_n").alias("_n"))
    )
    numbers = F.when(F.col("_gap") != "", F.sequence(F.lit(0), F.length("_gap") - 1))
    gaps = F.filter(numbers, lambda i: F.substring(F.col("_gap"), i + 1, F.lit(1)) == "1")
    none_missing = F.array().cast("array<int>")
    places = F.when(
        F.col("_gap").isNotNull(), F.concat(F.array(F.lit(OF_ROWS)), F.coalesce(gaps, none_missing))
    ).otherwise(F.array(F.lit(OF_TARGET)))
    return (
        folded.select("_of", F.explode(places).alias("_at"), "_n")
        .groupBy("_of", "_at")
        .agg(F.sum("_n").alias("_sum"), F.count(F.lit(1)).alias("_kinds"), F.min("_n").alias("_least"))
    )


def cell_facts(rows: DataFrame) -> DataFrame:
    """Row counts and missing values of every column, whether its rows with a target hold one value, and
    how many of its probed values different rows share; of whole rows (``OF_ROWS``), whether a probed one has
    copies. All fold before the shuffle.

    A value is probed by its own hash, so all its rows are, or by that of its row, which finds few-valued
    columns. Two different rows with the same value prove that a column is no identifier. Columns without
    such a proof are left to :func:`maybe_repeating` and :func:`repeating`.
    """
    floats = F.size("longs"), F.size("longs") + F.size("doubles")
    wide = rows.select(
        dataset_code(),
        floats[0].alias("_from"),
        floats[1].alias("_to"),
        F.size("fingerprint.hashes").alias("_width"),
        target_value_present().alias("_has"),
        F.col("fingerprint.a").alias("_a"),
        (F.pmod(F.xxhash64("fingerprint.a"), F.lit(PROBED_ROWS)) == 0).alias("_sampled"),
        F.concat("fingerprint.hashes", F.array("fingerprint.a")).alias("_hashes"),
    )
    wide = wide.select("*", F.posexplode("_hashes").alias("_place", "_hash"))
    value = F.when(F.col("_has"), F.col("_hash"))
    probed = F.col("_sampled") | (F.pmod(F.xxhash64(value), F.lit(PROBED)) == 0)
    is_float = (F.col("_place") >= F.col("_from")) & (F.col("_place") < F.col("_to"))
    counts = (
        wide.withColumn("_probe", F.when(probed & ~is_float, value))
        .withColumn("_row", F.when(F.col("_probe").isNotNull(), F.col("_a")))
        .withColumn("_at", F.when(F.col("_place") < F.col("_width"), F.col("_place")).otherwise(OF_ROWS))
        .groupBy("_of", "_at", "_probe")
        .agg(
            F.count(F.lit(1)).alias("_raw"),
            F.count_if("_has").alias("_target_raw"),
            F.count(value).alias("_found"),
            F.min(value).alias("_low"),
            F.max(value).alias("_high"),
            F.min("_row").alias("_first"),
            F.max("_row").alias("_last"),
        )
    )
    return (
        counts.groupBy("_of", "_at")
        .agg(
            F.sum("_raw").alias("raw_rows"),
            F.sum("_target_raw").alias("target_rows"),
            (F.sum("_target_raw") - F.sum("_found")).alias("_missing"),
            (F.min("_low") == F.max("_high")).alias("_one_value"),
            F.count_if(F.col("_first") != F.col("_last")).alias("_shared"),
            (F.count_if(F.col("_probe").isNotNull() & (F.col("_target_raw") > 1)) > 0).alias("_copied"),
        )
    )


def maybe_repeating(rows: DataFrame, wanted: DataFrame, count: int) -> DataFrame:
    """Those of the wanted columns (collection_id, dataset_id, store, slot, _at) that may hold a value twice
    in rows with a target, and the buckets these values are in. A hash of each value is moved; there are
    about ``count`` of them."""
    lists = wanted.groupBy(*KEY).agg(F.collect_list("_at").alias("_wanted"))
    hashed = (
        with_target_key(of_datasets(rows, lists))
        .select(*KEY, F.col("fingerprint.hashes").alias("_hashes"))
        .join(lists, KEY)
        .select(dataset_code(), "_hashes", F.explode("_wanted").alias("_at"))
        .select("_of", "_at", F.xxhash64(F.get("_hashes", F.col("_at"))).alias("_hash"))
    )
    at = ["_of", "_at"]
    named = wanted.select(*KEY, "store", "slot", "_at", dataset_code())
    return repeats(hashed, at, count).join(named, at).drop("_of")


def repeating(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Those of the wanted columns (collection_id, dataset_id, store, slot, _at, _buckets) in which different
    rows that have a target share a value. Only values of these buckets are shuffled."""
    lists = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("store", "slot", "_at", "_buckets")).alias("_wanted"))

    def entry(c: Column) -> Column:
        text = value_key(F.get("texts", c["slot"]))
        key = F.when(c["store"] == "longs", F.get("longs", c["slot"]).cast("string")).otherwise(text)
        return F.struct(c["store"].alias("store"), c["slot"].alias("slot"), key.alias("_key"))

    def meant(c: Column) -> Column:
        place = bucket(F.xxhash64(F.get("_hashes", c["_at"])))
        return c["_buckets"].isNull() | F.array_contains(c["_buckets"], place)

    cells = (
        with_target_key(of_datasets(rows, lists))
        .select(*KEY, F.col("fingerprint.a").alias("_a"), F.col("fingerprint.hashes").alias("_hashes"), "longs", "texts")
        .join(lists, KEY)
        .select(*KEY, "_a", F.inline(F.transform(F.filter("_wanted", meant), entry)))
    )
    values = cells.groupBy(*KEY, "store", "slot", "_key").agg(F.min("_a").alias("_first"), F.max("_a").alias("_last"))
    return values.where("_first != _last").select(*KEY, "store", "slot").distinct()


def with_target_key(rows: DataFrame) -> DataFrame:
    """Fleet rows whose key is missing where their target is, so that an inner join drops them."""
    has = target_value_present()
    return rows.withColumns({k: F.when(has, F.col(k)) for k in KEY})


def cleaned_column_stats(fleet: Fleet) -> DataFrame:
    """Statistics of every column over the different rows that have a target, plus the raw row counts.

    ``n_unique`` and ``min_count`` count the classes of targets; of other columns they are missing.
    ``is_unique`` tells whether every row has its own value. The results are stored, a row per column.
    """
    place = [*KEY, "store", "slot"]
    at = ["_of", "_at"]
    in_rows = F.max(F.when(F.col("_at") == OF_ROWS, F.col("_copied"))).over(Window.partitionBy("_of"))
    cells = cell_facts(fleet.rows).withColumn("_copied", in_rows)
    cells = staged(numbered(fleet.columns).join(cells, at, "left"), "cell-counts")
    probed = cells.where("target_rows > 1").select(*KEY, "target_rows", "_copied").distinct()
    copied = staged(
        maybe_copied(fleet.rows, probed.drop("target_rows"), total(probed.where("NOT _copied"), "target_rows")),
        "maybe-copied",
    )
    part = F.when(F.col("_buckets").isNull(), F.lit(1.0)).otherwise(F.size("_buckets") / F.lit(BUCKETS))
    meant = copied.join(probed.drop("_copied"), KEY).select(F.ceil(F.col("target_rows") * part).alias("_n"))
    facts = row_facts(fleet.rows, copied, total(meant, "_n"))
    missing = facts.where("_at >= 0").select(*at, F.col("_sum").alias("_less_missing"))
    whole = facts.where(F.col("_at") == OF_ROWS).select("_of", F.col("_sum").alias("_less"))
    classes = facts.where(F.col("_at") == OF_TARGET).select(
        "_of", F.lit(True).alias("is_target"), F.col("_kinds").alias("n_unique"), F.col("_least").alias("min_count")
    )
    joined = (
        cells.join(missing, at, "left")
        .join(whole, "_of", "left")
        .join(classes, ["_of", "is_target"], "left")
        .na.fill(0, ["raw_rows", "target_rows", "_missing", "_less_missing", "_less"])
        .withColumn("n_rows", F.col("target_rows") + F.col("_less"))
        .withColumn("n_missing", F.col("_missing") + F.col("_less_missing"))
        .drop("_of", "_missing", "_less_missing", "_less", "_copied")
    )
    joined = joined.withColumn("is_constant", F.coalesce("_one_value", F.lit(False))).drop("_one_value")
    counted = staged(
        joined.withColumn(
            "n_unique", F.when(F.col("is_target"), F.coalesce("n_unique", F.lit(0).cast("bigint")))
        ),
        "column-counts",
    )
    # Hashes of two values could agree once, not twice.
    undecided = (
        ~F.col("is_target")
        & (F.col("dtype") != "float")
        & ~F.col("is_constant")
        & (F.col("n_missing") == 0)
        & (F.col("n_rows") > 1)
        & (F.col("_shared") < 2)
    )
    wanted = counted.where(undecided)
    maybe = staged(
        maybe_repeating(fleet.rows, wanted.select(*place, "_at"), total(wanted, "target_rows")), "maybe-repeating"
    )
    shared = repeating(fleet.rows, maybe).withColumn("_again", F.lit(True))
    unique = undecided & F.col("_again").isNull()
    return staged(
        counted.join(shared, place, "left")
        .withColumn("is_unique", F.coalesce(unique, F.lit(False)))
        .drop("_again", "_shared", "_at"),
        "column-stats",
    )


def with_drop_flags(stats: DataFrame, limits: Limits) -> DataFrame:
    """Which feature columns go: sparse first, then constant, then identifiers."""
    feature = ~F.col("is_target")
    sparse = F.coalesce(
        share(F.col("n_missing"), F.col("n_rows")) > limits.max_missing_share, F.lit(False)
    )
    return (
        stats.withColumn("is_sparse", feature & sparse)
        .withColumn("is_constant", feature & ~F.col("is_sparse") & F.col("is_constant"))
        .withColumn(
            "is_id",
            feature
            & ~F.col("is_sparse")
            & ~F.col("is_constant")
            & F.col("is_unique")
            & (F.col("dtype") != "float"),
        )
        .withColumn("is_kept", ~(F.col("is_sparse") | F.col("is_constant") | F.col("is_id")))
    )


def first_failure(limits: Limits) -> Column:
    """Reason of the first gate a dataset fails; NULL when it passes them all."""
    classified = F.col("task") == "classification"
    n_classes, smallest = F.col("n_classes"), F.col("smallest_class")
    too_many_rows = F.lit(False) if limits.max_rows is None else F.col("n_instances") > limits.max_rows
    too_wide = (
        F.lit(False) if limits.max_features is None else F.col("n_features") > limits.max_features
    )
    return (
        F.when(~F.col("task").isin("classification", "regression"), "task_unsupported")
        .when(F.col("target_variable").isNull(), "target_not_found")
        .when(n_classes <= 1, "target_constant")
        .when(classified & (n_classes > limits.max_classes), "too_many_classes")
        .when(classified & (smallest < limits.min_class_size), "class_too_small")
        .when(smallest < limits.min_target_repeat, "singleton_target")
        .when((F.col("n_instances") < limits.min_rows) | too_many_rows, "row_count")
        .when((F.col("n_features") < limits.min_features) | too_wide, "feature_count")
    )


def kept_slots(store: str) -> Column:
    """Places of the kept columns in one store of the dataset's rows."""
    kept = F.when(F.col("is_kept") & (F.col("store") == store), F.col("slot"))
    return F.array_sort(F.collect_list(kept)).alias(f"kept_{store}")


def picked(store: str, slots: str) -> Column:
    return F.transform(slots, lambda i: F.get(store, i))


def screen_stats(stats: DataFrame, limits: Limits = Limits(), tasks: DataFrame | None = None) -> DataFrame:
    """One record per dataset: cleaning counts, dropped columns, final shape, status and reason.

    ``tasks`` (collection_id, dataset_id, task) overrides the task inferred from the raw target.
    Removing rows without a target, or copies, leaves the set of target values unchanged, so the
    raw task follows from the same counts.
    """
    flags = with_drop_flags(stats, limits)
    kept_feature = F.col("is_kept") & ~F.col("is_target")
    record = flags.groupBy(*KEY).agg(
        of_target(F.col("column_name")).alias("target_variable"),
        catalog_task(
            F.coalesce(of_target(F.col("dtype")), F.lit("none")),
            of_target(F.col("n_unique")),
            F.max("raw_rows"),
            limits,
        ).alias("task"),
        F.max("raw_rows").alias("raw_rows"),
        (F.max("raw_rows") - F.max("target_rows")).alias("missing_target_rows"),
        (F.max("target_rows") - F.max("n_rows")).alias("duplicate_rows"),
        F.max("n_rows").alias("n_instances"),
        F.coalesce(of_target(F.col("n_unique")), F.lit(0)).alias("n_classes"),
        of_target(F.col("min_count")).alias("smallest_class"),
        F.count_if(kept_feature).alias("n_features"),
        F.round(
            share(
                F.sum(F.when(F.col("is_kept"), F.col("n_missing"))),
                F.sum(F.when(F.col("is_kept"), F.col("n_rows"))),
            ),
            4,
        ).alias("missing_rate"),
        F.count_if(kept_feature & F.col("dtype").isin(NUMERIC_DTYPES)).alias("numeric"),
        F.count_if(kept_feature & (F.col("dtype") == "string")).alias("categorical"),
        names_where(F.col("is_sparse")).alias("sparse_columns"),
        names_where(F.col("is_constant")).alias("constant_columns"),
        names_where(F.col("is_id")).alias("id_columns"),
        *[kept_slots(store) for store in STORE_TYPES],
    )
    if tasks is not None:
        given = tasks.select(*KEY, F.col("task").alias("_task"))
        record = record.join(given, KEY, "left")
        record = record.withColumn("task", F.coalesce("_task", F.lit("unknown"))).drop("_task")
    reason = first_failure(limits)
    return record.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), "validated").otherwise("rejected")
    )


def screen(fleet: Fleet, limits: Limits = Limits(), tasks: DataFrame | None = None) -> DataFrame:
    """Screening record of every dataset of the fleet."""
    return screen_stats(cleaned_column_stats(fleet), limits, tasks)


def cleaning_report(screened: DataFrame) -> DataFrame:
    """What cleaning removed from each dataset."""
    return screened.select(
        *KEY,
        "missing_target_rows",
        "duplicate_rows",
        "sparse_columns",
        "constant_columns",
        "id_columns",
    )


def gate_outcomes(
    screened: DataFrame, ledger: DataFrame | None = None, failed: DataFrame | None = None
) -> DataFrame:
    """Status and reason of every dataset.

    Entries of ``ledger`` (collection_id, dataset_id, has_profile) without data or profile are
    rejected; datasets of ``failed`` (collection_id, dataset_id, reason) could not be read and get
    status ``error`` without stopping the rest.
    """
    outcomes = screened.select(*OUTCOME)
    if failed is not None:
        broken = failed.select(*KEY, F.col("reason").alias("_error"))
        outcomes = outcomes.join(broken, KEY, "left").select(
            *KEY,
            F.when(F.col("_error").isNotNull(), "error").otherwise(F.col("status")).alias("status"),
            F.coalesce("_error", "reason").alias("reason"),
        )
    if ledger is not None:
        entries = ledger.select(*KEY, "has_profile")
        found = outcomes.withColumn("_found", F.lit(True))
        gone = F.col("_found").isNull()
        bare = ~F.col("has_profile")
        outcomes = entries.join(found, KEY, "left").select(
            *KEY,
            F.when(gone | bare, "rejected").otherwise(F.col("status")).alias("status"),
            F.when(gone, "source_missing")
            .when(bare, "profile_missing")
            .otherwise(F.col("reason"))
            .alias("reason"),
        )
    return outcomes


def of_datasets(rows: DataFrame, wanted: DataFrame, most: int = 100) -> DataFrame:
    """Rows of the wanted datasets where these are few, so that tables of others are not read; else all."""
    keys = wanted.select(*KEY).limit(most + 1).collect()
    if len(keys) > most:
        return rows
    tests = [(F.col(KEY[0]) == c) & (F.col(KEY[1]) == d) for c, d in keys]
    return rows.where(reduce(lambda a, b: a | b, tests, F.lit(False)))


# Rows of so many datasets may lie in one task of a sink without being shuffled once more for it.
FEW_DATASETS = 16


def clean_fleet(
    fleet: Fleet,
    limits: Limits = Limits(),
    tasks: DataFrame | None = None,
    screened: DataFrame | None = None,
    by_dataset: bool = False,
) -> Fleet:
    """Cleaned rows and columns of the validated datasets.

    Whole rows are shuffled for validated datasets with copies only; all others are a map. The
    per-dataset record is joined by key: Spark broadcasts it when it is small and splits skewed
    datasets when not. ``screened`` is the fleet's screening record, where it is there already. With
    ``by_dataset``, for sinks, rows that were shuffled are laid out by dataset again if they are of more than
    ``FEW_DATASETS``, as each task may write a file for each; others are where their table was read.
    """
    screened = screen(fleet, limits, tasks) if screened is None else screened
    kept = {store: f"kept_{store}" for store in STORE_TYPES}
    passed = (
        screened.where(F.col("status") == "validated")
        .select(*KEY, *kept.values(), (F.col("duplicate_rows") > 0).alias("_copied"))
    )
    # One small row per dataset, used for rows and columns: stored, its size is known to Spark.
    passed = staged(passed, "passed")
    whole = ["row_id", "target_store", "target_slot", *STORE_TYPES]
    parts = []
    for copied in (False, True):
        some = passed.where(F.col("_copied") == copied)
        rows = with_target_key(of_datasets(fleet.rows, some)).select(*KEY, *whole)
        if copied:
            rows = distinct_rows(rows.join(some.select(*KEY), KEY, "left_semi")).select(*KEY, *whole)
            many = by_dataset and len(some.limit(FEW_DATASETS + 1).collect()) > FEW_DATASETS
            rows = rows.hint("rebalance", *KEY) if many else rows
        parts.append(rows.join(some, KEY))
    joined = parts[0].unionByName(parts[1])
    new_slot = F.lit(None).cast("bigint")
    for store, slots in kept.items():
        here = F.array_position(slots, F.col("target_slot")) - 1
        new_slot = F.when(F.col("target_store") == store, here).otherwise(new_slot)
    rows = joined.select(
        *KEY,
        "row_id",
        "target_store",
        new_slot.cast("int").alias("target_slot"),
        *[picked(store, slots).alias(store) for store, slots in kept.items()],
    )
    places = reduce(
        DataFrame.unionByName,
        [
            passed.select(*KEY, F.lit(store).alias("store"), F.explode(slots).alias("slot"))
            for store, slots in kept.items()
        ],
    )
    in_table = Window.partitionBy(*KEY).orderBy("ordinal")
    in_store = Window.partitionBy(*KEY, "store").orderBy("ordinal")
    columns = fleet.columns.join(places, [*KEY, "store", "slot"]).select(
        *KEY,
        F.row_number().over(in_table).alias("ordinal"),
        "column_name",
        "dtype",
        "is_target",
        "kind",
        "declared",
        "store",
        (F.row_number().over(in_store) - 1).alias("slot"),
    )
    return Fleet(with_fingerprint(rows), columns)
