"""Personal data, and the terms that give it away.

Base finds are e-mail addresses, IPv4 addresses, payment cards and phone numbers. Around each find, the
words of the same line, up to ``window`` on either side, are terms that may reveal it. Over the whole
corpus N documents are counted with a protected value c, with a term t, and with t near c. The term
discloses the value if its pointwise mutual information reaches a share ``alpha`` of the value's
information content:

    log(p(t, c) / (p(t) p(c))) >= alpha * -log p(c)

which says how much of c's surprise is gone once t is known; ``alpha`` = 1 means t occurs with c only.
An estimate is taken as it is if it rests on ``support`` different contexts (windows of different words).
On fewer, k of them, p(c | t) is lowered to the least share that shows k hits in a row with probability
``doubt``, which takes -log(doubt) / k from the mutual information; so copies of one document, which are
one context, don't make every rare word of it a disclosure. A value seen once or twice is also judged with
others of its class: a mail domain, the first three numbers of an IPv4 address, a card's issuer (six
digits), a phone number without its last four digits; the class counts as a protected value of its own.
Disclosing terms are generalised wherever they occur, and removed where they reveal a value fully
(``full``).

Terms travel as 64-bit hashes; a constant-size bit map of the candidates keeps other words out of the
shuffle, and an exact join follows, so it only saves work.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_slices
from .words import words

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("term", "removed")
MAP_BITS = 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a run of digits is tried from its start only: inside it fares no better
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Settings:
    window: int = 6
    alpha: float = 0.8
    full: float = 0.999
    support: int = 3
    doubt: float = 0.01


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the base finds: leftmost, not overlapping within a kind."""
    out = []
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append((m.start(), 0, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def _context(text: str, start: int, end: int, window: int) -> np.ndarray:
    """Hashes of the distinct words without digits beside the span, on its line."""
    left, right = text[text.rfind("\n", 0, start) + 1: start], text[end: len(text) if (e := text.find("\n", end)) < 0 else e]
    left, right = " ".join(left.rsplit(None, window)[-window:]), " ".join(right.split(None, window)[:window])
    w = words(pa.array([left, right], pa.string()))
    raw = w.data
    plain = np.array([not any(48 <= c <= 57 for c in raw[a:b]) and b - a > 2 for a, b in zip(w.start, w.end)], dtype=bool)
    near = np.concatenate([np.flatnonzero(w.row == 0)[-window:], np.flatnonzero(w.row == 1)[:window]])
    return np.unique(w.hash[near[plain[near]]]) if len(near) else np.zeros(0, np.uint64)


def entities(kind: int, found: str) -> tuple[str, str]:
    """The protected value of a base find, and its class."""
    value = found.lower() if kind < 2 else "".join(c for c in found if c.isdigit())
    group = (value[value.rfind("@") + 1:], value[:value.rfind(".")], value[:6], value[:-4])[kind]
    return f"{KINDS[kind]}:{value}", f"{KINDS[kind]} class:{group}"


def contexts(docs: DataFrame, text_col: str, window: int) -> DataFrame:
    """``(entity, context, term)``: one row per document, protected value or class and term near it; term null
    marks the document itself (once per document and value)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 0):
            rows: list[tuple[str, int, int | None]] = []
            for text in b.column(0).to_pylist():
                seen = set()
                for start, kind, end in base_spans(text or ""):
                    near = _context(text, start, end, window)
                    mark = int(np.bitwise_xor.reduce(near * np.uint64(0x9E3779B97F4A7C15))) >> 1 if len(near) else 0
                    for entity in entities(kind, text[start:end]):
                        if (entity, None) not in seen:
                            rows.append((entity, 0, None))
                            seen.add((entity, None))
                        for term in near.view(np.int64).tolist():
                            if (entity, term) not in seen:
                                rows.append((entity, mark, term))
                                seen.add((entity, term))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))],
                                                 names=["entity", "context", "term"])

    return docs.select(text_col).mapInArrow(run, "entity string, context long, term long")


def _bit_map(terms: DataFrame) -> np.ndarray:
    """2^20 flags, one set for each term's leading bits."""
    flags = np.zeros(1 << MAP_BITS, dtype=bool)
    slots = terms.select(F.shiftrightunsigned("term", 64 - MAP_BITS).cast("int").alias("s")).distinct().toPandas()  # at most 2^20 rows
    flags[slots["s"].to_numpy(dtype=np.int64)] = True
    return flags


def term_counts(docs: DataFrame, text_col: str, flags: np.ndarray) -> DataFrame:
    """``(term, n)``: documents that hold each flagged term, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 0):
            w = words(b.column(0))
            on = flags[w.hash >> np.uint64(64 - MAP_BITS)]
            pairs = np.unique(np.stack([w.hash[on], w.row[on].astype(np.uint64)]), axis=1) if on.any() else np.zeros((2, 0), np.uint64)
            term, n = np.unique(pairs[0], return_counts=True)
            if len(term):
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], names=["term", "n"])

    return docs.select(text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(docs: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """``(term, kind)``: kind 1 generalised, 2 removed."""
    s = settings
    near = cut(contexts(docs, text_col, s.window))
    values = near.where("term is null").groupBy("entity").agg(F.count("*").alias("n_c"))
    together = (near.where("term is not null").groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
                .groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("n").alias("n_tc")))
    total = docs.agg(F.count("*").alias("total"))
    info = F.greatest(-F.log(F.col("n_c") / F.col("total")), F.lit(1e-9))
    unsure = F.when(F.col("contexts") >= s.support, 0.0).otherwise(-F.log(F.lit(s.doubt)) / F.col("contexts"))
    candidates = cut(together.join(values, "entity").withColumn("total", total.scalar()).withColumn("info", info).withColumn("unsure", unsure)
                     .where(F.col("info") - F.col("unsure") >= s.alpha * F.col("info") - 1e-9))  # no term tells more than info
    counts = term_counts(docs, text_col, _bit_map(candidates))
    told = (F.log(F.col("n_tc") * F.col("total") / (F.col("n") * F.col("n_c"))) - F.col("unsure")) / F.col("info")
    return (candidates.join(counts, "term").withColumn("told", told)
            .where(F.col("told") >= s.alpha).groupBy("term").agg(F.max(F.when(F.col("told") >= s.full, 2).otherwise(1)).alias("kind")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), with_text: bool = False) -> DataFrame:
    """``(doc_id, found[, text])``: one row per row of ``docs``; found has (start, at, end, kind) by start, then kind.

    Kinds in order: email, ip, card, phone, term (to be generalised), removed. Spans are code points, end
    exclusive. A null text counts as empty and has no finds; repeated rows repeat; a null id is kept as
    null; other columns are ignored; an empty table gives an empty result.
    """
    terms = cut(disclosing_terms(docs, text_col, settings))
    flags = _bit_map(terms)
    any_term = bool(flags.any())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 1):
            base = [[{"start": a, "at": k, "end": e} for a, k, e in base_spans(t or "")] for t in b.column(1).to_pylist()]
            hits: list[list[dict]] = [[] for _ in base]
            if any_term:
                w = words(b.column(1))
                on = np.flatnonzero(flags[w.hash >> np.uint64(64 - MAP_BITS)])
                row = w.row[on]
                for r, term, a, e in zip(row.tolist(), w.hash[on].view(np.int64).tolist(), w.points(w.start[on], row).tolist(), w.points(w.end[on], row).tolist()):
                    hits[r].append({"term": term, "start": a, "end": e})
            cols = [b.column(0), pa.array(base, span), pa.array(hits, hit)]
            yield pa.RecordBatch.from_arrays(cols + [b.column(1)] * with_text, names=names)

    span = pa.list_(pa.struct([("start", pa.int32()), ("at", pa.int32()), ("end", pa.int32())]))
    hit = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))
    names = ["doc_id", "base", "hits"] + ["text"] * with_text
    schema = (f"doc_id {kind}, base array<struct<start: int, at: int, `end`: int>>, hits array<struct<term: long, start: int, `end`: int>>"
              + ", text string" * with_text)
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
               .withColumn("_row", F.monotonically_increasing_id()))
    added = (rows.where(F.size("hits") > 0).select("_row", F.explode("hits").alias("h")).select("_row", "h.*").join(terms, "term")
             .groupBy("_row").agg(F.collect_list(F.struct("start", (F.col("kind") + len(KINDS) - 1).cast("int").alias("at"), "end")).alias("added")))
    label = F.array(*[F.lit(k) for k in KINDS + TERM_KINDS])
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.expr("cast(array() as array<struct<start: int, at: int, `end`: int>>)"))))
    named = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["at"].alias("at"), x["end"].alias("end"), F.get(label, x["at"]).alias("kind")))
    return rows.join(added, "_row", "left").select("doc_id", named.alias("found"), *["text"] * with_text)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, text, found)``: base finds replaced by their kind in capitals, disclosing terms by
    [TERM], and fully revealing ones removed. Overlapping spans are replaced once, by the first one's
    mark; a null text stays null."""
    marks = {"term": "[TERM]", "removed": "", **{k: f"[{k.upper()}]" for k in KINDS}}
    found = find(docs, id_col, text_col, settings, with_text=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 2):
            out = []
            for spans, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                parts, done = [], 0
                for x in spans:
                    if x["start"] >= done:
                        parts += [text[done:x["start"]], marks[x["kind"]]]
                    done = max(done, x["end"])
                out.append(text if text is None else "".join(parts) + text[done:])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), b.column(1)], names=["doc_id", "text", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, text string, found array<struct<start: int, at: int, `end`: int, kind: string>>")
