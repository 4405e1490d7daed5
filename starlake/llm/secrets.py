"""Secret scans over a content-addressed ledger, in DataFrame operations only.

Every historical version of every path is addressed by its content (SHA-256 of the UTF-8 text). The
ledger, a Parquet table in the shared folder, says which rule versions each blob has been scanned with
and what was found. A scan reads the ledger, scans only blobs that lack some rule version, with just
the rules they lack, appends one ledger row per blob, and joins findings back to all paths. Copies of a
text are scanned once; a new rule or a raised rule version rescans old blobs with that rule alone.

Spans are code points, end exclusive, leftmost and non-overlapping per rule; letters in either case are
ASCII letters. Regular expressions give
a text's matches and the pieces between them; a match starts at the running sum of the lengths before
it. Matches whose checked group is too short are dropped after they have taken their place.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, fresh, scratch_dir, small


@dataclass(frozen=True)
class Rule:
    """A pattern in Java syntax; a match counts if group ``group`` has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}"),  # a whole run of 24+ characters
)
ADDED = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("bearer", 1, r"(?:gh[pousr]_[A-Za-z0-9]{36,})|(?:xox[abprs]-[A-Za-z0-9-]{10,})|(?:eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"),
)
RULES = BASE + ADDED

BROADCAST_BLOBS = 1_000_000  # 32 bytes each

LEDGER = "blob binary, rules array<string>, found array<struct<rule: string, start: int, end: int>>"


def _matches(rule: Rule, text: Column) -> Column:
    """Per match: the length of the text since the match before, its own length, and whether it counts."""
    p = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    lens = F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda x: F.length(x))
    sure = lens if not rule.group else F.transform(F.regexp_extract_all(text, p, F.lit(rule.group)), lambda x: F.length(x))
    both = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(lens)).alias("gap"), lens.alias("len"), sure.alias("sure"))
    return F.transform(both, lambda x: F.struct(
        F.lit(rule.key).alias("rule"), x["gap"].alias("gap"), x["len"].alias("len"), (x["sure"] >= rule.least).alias("ok")))


def _content(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blobs(blob, text, missing)`` -> ledger rows: the missing rules' findings of each blob."""
    none = F.expr("cast(array() as array<struct<rule: string, gap: int, len: int, ok: boolean>>)")
    hits = [F.when(F.array_contains("missing", r.key) & F.col("text").rlike(r.pattern), _matches(r, F.col("text"))).otherwise(none) for r in rules]
    raw = cut(blobs.select("blob", "missing", F.concat(*hits).alias("hits")))
    before = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    spans = (raw.select("blob", F.posexplode("hits").alias("at", "h")).select("blob", "at", "h.*")
             .withColumn("start", (F.coalesce(F.sum(F.col("gap") + F.col("len")).over(before), F.lit(0)) + F.col("gap")).cast("int"))
             .where("ok").groupBy("blob")
             .agg(F.sort_array(F.collect_list(F.struct("rule", "start", (F.col("start") + F.col("len")).cast("int").alias("end")))).alias("found")))
    return raw.select("blob", F.col("missing").alias("rules")).join(spans, "blob", "left").select(
        "blob", "rules", F.coalesce("found", F.expr("cast(array() as array<struct<rule: string, start: int, end: int>>)")).alias("found"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def _hashes(versions: DataFrame, text_col: str) -> DataFrame:
    """The different contents of ``versions``, written: ``blob``. Texts don't move for it."""
    return small(cut(versions.select(_content(F.coalesce(F.col(text_col), F.lit(""))).alias("blob")).distinct()), BROADCAST_BLOBS)


def _todo(hashes: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, missing)`` of the blobs that lack some rule version; of the ledger only rows of these blobs are gathered."""
    none = F.expr("cast(array() as array<string>)")
    keys = F.array(*[F.lit(r.key) for r in rules])
    seen = (read_ledger(hashes.sparkSession, ledger).join(hashes, "blob", "left_semi")
            .groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen")))
    return hashes.join(seen, "blob", "left").select("blob", F.array_except(keys, F.coalesce("seen", none)).alias("missing")).where(F.size("missing") > 0)


def unseen(versions: DataFrame, text_col: str, todo: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``(blob, text, missing)``: one text for each blob of ``todo`` (written). Up to ``rows`` blobs are looked up where the
    texts lie, so only texts to be scanned are shuffled; beyond that copies are merged first and then joined."""
    texts = versions.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("blob", _content(F.col("text")))
    if todo.count() <= rows:
        texts = texts.join(F.broadcast(todo.select("blob")), "blob", "left_semi")
    return texts.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob").select("blob", "text", "missing")


def _update(versions: DataFrame, text_col: str, hashes: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    spark = versions.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)  # a new ledger starts empty
    todo = cut(_todo(hashes, ledger, rules))
    added = cut(scan_blobs(unseen(versions, text_col, todo, BROADCAST_BLOBS), rules))
    added.write.mode("append").parquet(ledger)
    return added


def update_ledger(versions: DataFrame, text_col: str, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks and append it; returns the rows that were added. The ledger is asked by content
    hash before any text is moved, so versions that it knows cost one pass over their texts and no shuffle of them."""
    return _update(versions, text_col, _hashes(versions, text_col), ledger, rules)


def scan(versions: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(id_col, blob, found)``: one row per row of ``versions``; ``found`` has (kind, start, end, at).

    ``ledger`` is a path in shared storage; without one a new, empty ledger is used, so every distinct
    blob is scanned. ``found`` holds the findings of the given rules at their given versions, ordered
    by start, then by the order of ``rules`` (``at``). A null text counts as empty; empty texts have no
    findings; repeated rows and copies each get the findings of their blob; a null id is kept as null.
    Columns other than the two named are ignored; an empty table gives an empty result. If the id column itself is
    named ``blob`` or ``found``, the new column of that name gets an underscore before it.
    """
    spark = versions.sparkSession
    path = ledger or scratch_dir(spark)
    hashes = _hashes(versions, text_col)
    _update(versions, text_col, hashes, path, rules)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    kind = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.kind))])
    known = cut(read_ledger(spark, path).join(hashes, "blob", "left_semi").groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
             .withColumn("found", F.filter("found", lambda x: x["rule"].isin([r.key for r in rules])))
             .where(F.size("found") > 0)
             .withColumn("found", F.array_sort(F.transform("found", lambda x: F.struct(
                 x["start"].alias("start"), order[x["rule"]].alias("at"), x["end"].alias("end"), kind[x["rule"]].alias("kind"))))))
    paths = versions.select(F.col(id_col).alias("_id"), _content(F.coalesce(F.col(text_col), F.lit(""))).alias("blob"))
    empty = F.expr("cast(array() as array<struct<start: int, at: int, end: int, kind: string>>)")
    blob, found = fresh([id_col], "blob", "found")
    return paths.join(known, "blob", "left").select(F.col("_id").alias(id_col), F.col("blob").alias(blob), F.coalesce("found", empty).alias(found))


def redact(docs: DataFrame, text_col: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES,
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding (overlaps joined) in ``text_col`` replaced by ``mark``; all rows and
    columns stay, texts without a finding are unchanged, a null text stays null."""
    spark = docs.sparkSession
    path = ledger or scratch_dir(spark)
    hashes = _hashes(docs, text_col)
    _update(docs, text_col, hashes, path, rules)
    keys = [r.key for r in rules]
    known = (read_ledger(spark, path).join(hashes, "blob", "left_semi").groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("f"))
             .withColumn("f", F.sort_array(F.transform(F.filter("f", lambda x: x["rule"].isin(keys)),
                                                       lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e")))))
             .where(F.size("f") > 0)
             .withColumn("f", F.aggregate(
                 "f", F.expr("cast(array() as array<struct<s: int, e: int>>)"),
                 lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["e"] > x["s"]), F.concat(
                     F.slice(done, F.lit(1), F.size(done) - 1),
                     F.array(F.struct(F.element_at(done, -1)["s"].alias("s"), F.greatest(F.element_at(done, -1)["e"], x["e"]).alias("e")))))
                 .otherwise(F.concat(done, F.array(x))))))
    blob, found = fresh(docs.columns, "_blob", "_found")
    known = small(cut(known.select(F.col("blob").alias(blob), F.col("f").alias(found))), 500_000, F.size(found))
    text = F.col(text_col)
    clean = F.concat(
        F.array_join(F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.concat(
            F.substring(text, F.when(i == 0, 1).otherwise(F.get(found, i - 1)["e"] + 1),
                        F.get(found, i)["s"] - F.when(i == 0, 0).otherwise(F.get(found, i - 1)["e"])), F.lit(mark))), ""),
        F.substring(text, F.element_at(found, -1)["e"] + 1, F.length(text)))
    joined = docs.withColumn(blob, _content(F.coalesce(text, F.lit("")))).join(known, blob, "left")
    return joined.select(*[F.when(F.col(found).isNull(), text).otherwise(clean).alias(c) if c == text_col else F.col(c) for c in docs.columns])
