"""Secret scans through an incremental blob ledger, in DataFrame functions only.

Every text is a blob, addressed by its SHA-256. The ledger has one row per scan of a blob: the rules
(kind and version) that ran and the spans they found. A run reads the ledger, scans only pairs of blob
and rule version that it lacks, appends them, and joins the findings back to all rows by address.

Which blobs lack something is decided on addresses alone; then one row of each such blob is read again,
in place. The places of matches are running sums over pieces of a text as rows, so the work of a text grows
with its length and its hits, not with their product.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevet.llm.common import addressed, by_address, join_by_size, spare_names
from tablevet.session import scratch_path, staged


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern``; those whose ``group`` is shorter than
    ``least`` are dropped after matching. A new version makes every blob unseen for this rule."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Base patterns, then formats of public token families.
BASE_RULES = (
    Rule(
        "assign",
        "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{24,}", least=24),
)
RULES = (
    *BASE_RULES,
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+"),
)

# A stored span names the rule version that found it, so a later version replaces it.
FOUND = "struct<start:int,end:int,rule:string>"
SPAN = "struct<start:int,kind_no:int,kind:string,end:int>"
LEDGER = f"blob binary, rules array<string>, spans array<{FOUND}>"
# Findings of a blob with more spans are never broadcast. Texts are masked in pieces of so many characters.
BROADCAST_SPANS = 1_000
MASK_PIECE = 1_024


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def pieces_of(text: Column, rule: Rule) -> Column:
    """The gaps between a rule's matches, the matches and their values, as lengths in code points; null
    where nothing matches, which takes one search of the text."""
    pattern = F.lit(rule.pattern)
    pieces = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("hit"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("value"),
    )
    return F.when(text.rlike(rule.pattern), pieces)


def found_spans(texts: DataFrame, keys: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """(keys, spans) of the texts in which some rule finds something; ``keys`` name a row.

    A match begins after all gaps and matches before it, a running sum over the rows of a text and rule.
    """
    per_rule = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.least).alias("least"), pieces_of(F.col("text"), r).alias("pieces"))
        for r in rules
    ]
    hits = texts.select(*keys, F.inline(F.array(*per_rule))).where("pieces IS NOT NULL")
    hits = hits.select(*keys, "rule", "least", F.posexplode("pieces").alias("number", "piece"))
    upto = Window.partitionBy(*keys, "rule").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    piece = F.col("piece")
    end = F.sum(piece["gap"] + F.coalesce(piece["hit"], F.lit(0))).over(upto).cast("int")
    hits = hits.withColumn("end", end).where(piece["hit"].isNotNull() & (piece["value"] >= F.col("least")))
    span = F.struct((F.col("end") - piece["hit"]).alias("start"), "end", "rule")
    return hits.groupBy(*keys).agg(F.collect_list(span).alias("spans"))


def ledger_table(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, empty where there is none yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    if exists:
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], T._parse_datatype_string(LEDGER))


def unseen(paths: DataFrame, keys: list[str], ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(keys, blob, rules): one row of each blob that lacks some rule, and the rules it lacks."""
    names = F.array(*[F.lit(r.name) for r in rules]).cast("array<string>")
    one = paths.groupBy("blob").agg(F.min(F.struct(*keys)).alias("at"))
    done = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
    missing = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
    open_ = one.join(done, "blob", "left").withColumn("rules", missing).where("size(rules) > 0")
    return open_.select(*[F.col("at")[k].alias(k) for k in keys], "blob", "rules")


def scan_unseen(
    docs: DataFrame, keys: list[str], paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...], text_col: str
) -> DataFrame | None:
    """New ledger rows, or none. Texts are filtered by row address and scanned where they are read; the
    shorter of the two lists, of rows to read or to pass over, is joined."""
    todo = staged(unseen(paths, keys, ledger, rules), "unseen")
    # Blobs lack all rules or the new ones: few different sets, at most one for each set of rules.
    lacking = [(tuple(r["rules"]), r["n"]) for r in todo.groupBy("rules").agg(F.count(F.lit(1)).alias("n")).collect()]
    total = paths.count()
    parts = []
    for names, n in lacking:
        wanted = todo.where(F.col("rules") == F.array(*map(F.lit, names)))
        if 2 * n <= total:
            rows = by_address(docs, keys, wanted, "left_semi")
        else:
            rows = by_address(docs, keys, paths.join(wanted, keys, "left_anti"), "left_anti")
        text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
        parts.append(found_spans(rows.select(*keys, text), keys, tuple(r for r in rules if r.name in names)))
    if not parts:
        return None
    found = reduce(DataFrame.unionByName, parts)
    none = F.array().cast(f"array<{FOUND}>")
    return todo.join(found, keys, "left").select("blob", "rules", F.coalesce("spans", none).alias("spans"))


def current_spans(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans): what these versions of the rules found, in order; blobs without a finding are
    left out. Findings of other versions stay in the ledger and are not reported."""
    names = F.array(*[F.lit(r.name) for r in rules]).cast("array<string>")
    kinds = F.array(*[F.lit(r.kind) for r in rules]).cast("array<string>")

    each = ledger.select("blob", F.explode("spans").alias("s")).select("blob", "s.start", "s.end", "s.rule")
    each = each.where(F.array_contains(names, F.col("rule"))).distinct()  # a blob may have been scanned twice
    number = (F.array_position(names, F.col("rule")) - 1).cast("int")
    span = F.struct("start", number.alias("kind_no"), F.get(kinds, number).alias("kind"), "end")
    return each.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def scan(
    docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, blob, spans) of every row of ``docs``, and the ledger brought up to date.

    Null texts are empty, null and repeated ids are rows like others, and only the two columns are
    read. Copies of a text fold before the shuffle and are scanned once, whatever their number.
    """
    docs, keys = addressed(docs)
    out = _scan(docs, keys, ledger_path, rules, id_col, text_col)
    return out.select("doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def _scan(
    docs: DataFrame, keys: list[str], ledger_path: str, rules: tuple[Rule, ...], id_col: str, text_col: str
) -> DataFrame:
    """(keys, doc_id, blob, length, spans) of every row; spans are null where nothing was found."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_ = F.lit(None).cast("bigint").alias("doc_id") if id_col is None else F.col(id_col).alias("doc_id")
    paths = staged(docs.select(*keys, id_, address(text).alias("blob"), F.length(text).alias("length")), "paths")
    new = scan_unseen(docs, keys, paths, ledger_table(spark, ledger_path), rules, text_col)
    if new is not None:
        new.write.mode("append").parquet(ledger_path)
    counts = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("copies"))
    spans = current_spans(ledger_table(spark, ledger_path), rules)
    # Only short findings of blobs with many copies are broadcast.
    few = F.when(F.size("spans") <= BROADCAST_SPANS, F.col("copies")).otherwise(0)
    # Estimates miss the spans of a blob and, below, the pieces of a text, so neither may be broadcast by them.
    findings = staged(spans.hint("merge").join(counts, "blob").withColumn("n", few).drop("copies"), "findings")
    return join_by_size(paths, findings, "blob", "n", paths.count())


def joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(text, ",")


def secret_report(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Counts and spans of the base rules, and the spans of all rules, for every row."""
    path = ledger_path or scratch_path(docs.sparkSession, "ledger")
    base = [r.kind for r in BASE_RULES]
    s = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scan(docs, path).select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(joined(F.filter(s, lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        joined(s).alias("spans"),
    )


def keep_clean(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger_path: str | None = None) -> DataFrame:
    """``docs`` with every character of every span masked by an asterisk, all rows and columns.

    Null and empty texts stay as they are, repeated rows and null ids are rows like others, an empty
    table gives no rows, and columns of any name are kept. Only texts with a finding move, and only they
    are rewritten.
    """
    docs, keys = addressed(docs)
    path = ledger_path or scratch_path(docs.sparkSession, "ledger")
    found = _scan(docs, keys, path, rules, None, "text").where("size(spans) > 0")
    return mask(docs, keys, staged(found.select(*keys, "length", "spans"), "found")).drop(*keys)


def mask(docs: DataFrame, keys: list[str], found: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``found`` (keys, length, spans) masked; ``keys`` name a row.

    A text is masked in pieces of MASK_PIECE characters, each by the spans that touch it, so the work
    follows the length of the text and the number of spans. Spans may overlap.
    """
    (parts,) = spare_names(docs, "parts")
    piece = lambda at: F.floor(at / MASK_PIECE).cast("int")
    spans = found.select(*keys, F.explode("spans").alias("s")).select(*keys, "s.start", "s.end")
    touched = spans.withColumn("c", F.explode(F.sequence(piece(F.col("start")), piece(F.col("end") - 1))))
    begin = F.col("c") * MASK_PIECE
    local = F.struct(
        F.greatest(F.col("start") - begin, F.lit(0)).alias("start"), F.least(F.col("end") - begin, F.lit(MASK_PIECE)).alias("end")
    )
    every = found.select(*keys, F.explode(F.sequence(F.lit(0), piece(F.col("length") - 1))).alias("c"))
    marks = touched.select(*keys, "c", local.alias("m")).unionByName(every.select(*keys, "c", F.lit(None).alias("m")), True)
    dense = marks.groupBy(*keys, "c").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    dense = dense.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("c", "ms"))).alias(parts))

    def masked(text: Column, marks: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(state: Column, m: Column) -> Column:
            first, last = F.greatest(m["start"], state["at"]), F.greatest(m["end"], state["at"])
            before = F.substr(text, state["at"] + 1, first - state["at"])
            return F.struct(last.alias("at"), F.concat(state["out"], before, F.repeat(F.lit("*"), last - first)).alias("out"))

        return F.aggregate(marks, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1)))

    cut = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{MASK_PIECE}}}"), F.lit(0))
    pieces = F.transform(cut, lambda text, i: masked(text, F.get(F.col(parts), i)["ms"]))
    clean = by_address(docs, keys, found, "left_anti")
    named = by_address(docs, keys, found, "left_semi").join(dense.hint("merge"), keys)
    rewritten = named.select(*[F.array_join(pieces, "").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
    return clean.unionByName(rewritten)
