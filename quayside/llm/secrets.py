r"""Secrets in texts: strong ones by their form, weak ones only where complementary parts meet.

A password after ``password =``, an access identifier or a long hexadecimal run is a finding by
itself. A user name, a short password, a bare 40-character key or an endpoint is not: it becomes one
where a part that completes it lies within ``reach`` characters of the same text. Those pairs are
found by an interval join: every part is put under the ``reach``-wide cells that its surroundings
touch, and a weak candidate looks only into its own cell. It is a semi-join, so no pair is emitted
however many parts a text holds.

All is built of SQL functions. Positions come from splitting a text at a pattern and adding up the
lengths of gaps and matches, in code points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.running import cut_out, running
from quayside.plans.settle import settle


@dataclass(frozen=True)
class Part:
    """kind, pattern and the group whose length must lie in shortest..longest. completes: weak kinds it supports."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 0
    longest: int = 1 << 30
    weak: bool = False
    completes: tuple[str, ...] = ()
    hint: str = ""  # a text without this pattern holds no match


_VALUE = r"[\"']?\x20*[:=]\x20*[\"']?"
_ASSIGN = rf"((?i:password|passwd|secret|token|api_?key)){_VALUE}([A-Za-z0-9+/_.=-]+)"
# In the order in which kinds are listed.
PARTS = (
    Part("assign", _ASSIGN, 2, 8, completes=("ident", "endpoint"), hint="[:=]"),
    Part("access", r"AKIA[A-Z0-9]{12,}", completes=("key",), hint="AKIA"),
    Part("hex", r"[0-9a-f]{32,}"),
    Part("key", r"[A-Za-z0-9+/=]{40,}", 0, 40, 40, True, ("ident",)),
    Part("short", _ASSIGN, 2, 4, 7, True, ("ident", "endpoint"), hint="[:=]"),
    Part("ident", rf"((?i:user_?name|user|login|account|client_?id)){_VALUE}([A-Za-z0-9._@-]+)", 2, 3, weak=True, completes=("key", "short"), hint="[:=]"),
    Part("endpoint", r"https?://[^\x09-\x0D\x20\"'<>]+|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", weak=True, completes=("short",), hint=r"://|[0-9]\.[0-9]"),
)
BASE = ("assign", "access", "hex")
REACH = 120

_SPANS = "array<struct<start:int,rank:int,end:int>>"
_GAPS = "array<struct<from:int,to:int>>"


def _found(text: Column, rank: int, part: Part) -> Column:
    """Spans of one kind. A pattern never matches nothing, so gaps and matches alternate."""
    pattern = F.lit(part.pattern)
    pieces = F.arrays_zip(
        F.split(text, part.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), F.regexp_extract_all(text, pattern, F.lit(part.group)).alias("value")
    )

    none = F.array().cast(_SPANS)

    def ends(at: Column, piece: Column) -> Column:
        return at + F.length(piece["gap"]) + F.coalesce(F.length(piece["match"]), F.lit(0))

    def span(at: Column, piece: Column) -> Column:
        fits = piece["match"].isNotNull() & F.length(piece["value"]).between(part.shortest, part.longest)
        found = F.struct((at + F.length(piece["gap"])).alias("start"), F.lit(rank).alias("rank"), ends(at, piece).alias("end"))
        return F.when(fits, F.array(found)).otherwise(none)

    spans = running(pieces, F.lit(0), ends, span, _SPANS)
    seen = text.rlike(part.pattern)
    return F.when((text.rlike(part.hint) & seen) if part.hint else seen, spans).otherwise(none)


def _told(spans: Column, kinds: Sequence[str]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, parts: Sequence[Part] = PARTS, reach: int = REACH, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, findings, and the ``carry`` columns.

    findings is an array of (start, rank, end) in code points, end exclusive, by start and then by
    place in ``parts``. Null and empty texts have none. Matches of one kind never overlap, those of
    different kinds may. Rows with equal or null doc_id are scanned each for itself. Texts are read
    whole. Columns that are not named are dropped, so their names cannot clash. An empty table gives
    an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = list(dict.fromkeys(c for c in carry if c != "doc_id"))
    strong = F.concat(*[_found(text, i, p) for i, p in enumerate(parts) if not p.weak])
    weak = F.concat(*[_found(text, i, p) for i, p in enumerate(parts) if p.weak])
    rows = settle(
        docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(kept)], strong.alias("_strong"), weak.alias("_weak")),
        "parts",
    )

    wanted = {p.kind: i for i, p in enumerate(parts)}
    serves = F.create_map(*[x for i, p in enumerate(parts) for x in (F.lit(i), F.array(*[F.lit(wanted[k]) for k in p.completes]).cast("array<int>"))])
    some = rows.where(F.size("_weak") > 0).select("_row", "_weak", "_strong")
    spread = some.select("_row", F.explode(F.concat("_strong", "_weak")).alias("p")).select("_row", F.explode(serves[F.col("p.rank")]).alias("rank"), "p.start", "p.end")
    # Under every cell that the part's surroundings touch.
    cells = F.sequence(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach))
    around = spread.select("_row", "rank", F.explode(cells).alias("cell"), F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    asked = some.select("_row", F.explode("_weak").alias("w")).select("_row", "w.start", "w.rank", "w.end", F.floor(F.col("w.start") / reach).alias("cell"))
    near = (F.col("start") <= F.col("p_end") + reach) & (F.col("end") >= F.col("p_start") - reach)
    same = (asked["_row"] == around["_row"]) & (asked["rank"] == around["rank"]) & (asked["cell"] == around["cell"])
    linked = asked.join(around, same & near, "left_semi")
    reported = linked.groupBy("_row").agg(F.collect_list(F.struct("start", "rank", "end")).alias("_linked"))
    # The linked spans of a row are a part of what one row held before.
    whole = rows.join(reported, "_row", "left")
    findings = F.array_sort(F.concat("_strong", F.coalesce("_linked", F.array().cast(_SPANS))))
    return whole.select("doc_id", findings.alias("findings"), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)])


def summary(scanned: DataFrame, parts: Sequence[Part] = PARTS, base: Sequence[str] = BASE) -> DataFrame:
    """doc_id, a count per base kind, base_sha256 over the base spans, and all spans as text."""
    kinds = [p.kind for p in parts]
    only = F.filter("findings", lambda s: s["rank"].isin([kinds.index(k) for k in base]))
    of_kind = lambda i: F.filter("findings", lambda s: s["rank"] == i)
    counts = [F.size(of_kind(kinds.index(k))).cast("bigint").alias(f"n_{k}") for k in base]
    return scanned.select("doc_id", *counts, F.sha2(_told(only, kinds).cast("binary"), 256).alias("base_sha256"), _told(F.col("findings"), kinds).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", parts: Sequence[Part] = PARTS, reach: int = REACH) -> DataFrame:
    """``docs`` with each finding in ``text`` replaced by ``mark``, overlapping ones by one; other columns stay.

    Null texts stay null.
    """

    # What lies between findings, from the end of all before to the start of the next; none inside overlapping ones.
    between = lambda at, s: F.when(s["start"] >= at, F.array(F.struct(at.alias("from"), s["start"].alias("to")))).otherwise(F.array().cast(_GAPS))
    gaps = running(F.col("findings"), F.lit(0), lambda at, s: F.greatest(at, s["end"]), between, _GAPS)

    scanned = scan(docs, parts, reach, carry=docs.columns)
    last = F.array_max(F.transform("findings", lambda s: s["end"]))
    texts = F.concat(cut_out(F.col("text"), F.col("_gaps"), lambda g: g["from"], lambda g: g["to"]), F.array(F.substring(F.col("text"), last + 1, F.length("text"))))
    clean = F.when(F.size("findings") == 0, F.col("text")).otherwise(F.array_join(texts, mark))
    return scanned.withColumn("_gaps", gaps).select(*[clean.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def oracle(parts: Sequence[Part] = PARTS, reach: int = REACH) -> str:
    """``summary(scan(documents))`` as DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    spans = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS rank, {quote(p.kind)} AS kind, {str(p.weak).lower()} AS weak, begin AS s, begin + len(m) AS e FROM ("
        f"SELECT doc_id, m, v, sum(len(g) + len(m)) OVER (PARTITION BY doc_id ORDER BY k) - len(m) AS begin FROM ("
        f"SELECT doc_id, unnest(range(1, len(ms) + 1)) AS k, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[1:len(ms)]) AS g FROM ("
        f"SELECT doc_id, regexp_extract_all(t, {quote(p.pattern)}) AS ms, regexp_extract_all(t, {quote(p.pattern)}, {p.group}) AS vs, string_split_regex(t, {quote(p.pattern)}) AS gs FROM texts))) "
        f"WHERE len(v) BETWEEN {p.shortest} AND {p.longest}"
        for i, p in enumerate(parts)
    )
    rules = ", ".join(f"({quote(p.kind)}, {quote(k)})" for p in parts for k in p.completes)
    base = ", ".join(quote(k) for k in BASE)
    joined = lambda cond: f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE {cond}), '')"
    return (
        f"WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), rules(part, weak_kind) AS (VALUES {rules}), spans AS ({spans}), "
        f"kept AS (SELECT * FROM spans w WHERE NOT weak OR EXISTS (SELECT 1 FROM spans p JOIN rules r ON r.part = p.kind "
        f"WHERE p.doc_id = w.doc_id AND r.weak_kind = w.kind AND w.s <= p.e + {reach} AND w.e >= p.s - {reach})) "
        f"SELECT d.doc_id, " + ", ".join(f"count(*) FILTER (WHERE kind = {quote(k)})::BIGINT AS n_{k}" for k in BASE) + ", "
        f"sha256({joined(f'kind IN ({base})')}) AS base_sha256, {joined('kind IS NOT NULL')} AS spans "
        f"FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id"
    )
