"""Secret scans with a ledger of blobs: only unseen contents are scanned, per rule version."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.batches import BatchFolder
from lakeops.workspace import stored


@dataclass(frozen=True)
class Rule:
    """A pattern (Java syntax), its version, and how long what it finds must be.

    ``least`` counts the code points of ``group``, and findings that fail are dropped after
    matching, so they still use up the text they cover. ``hint`` is a cheap pattern without
    which the rule finds nothing.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    hint: str | None = None
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


# The base rules, in order of kind.
BASE = (
    Rule(
        "assign",
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        1,
        hint=r"(?i)(?:password|passwd|secret|token|api_?key)",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20, hint=r"AKIA"),
    # a run of 24 or more; shorter runs would be found and dropped
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Rules beyond the base: begin of a private key, and tokens with a known prefix.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, hint="PRIVATE KEY"),
    Rule("prefixed", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})", 1, hint=r"gh[pousr]_|xox"),
)
RULES = BASE + MORE

#: Findings are broadcast to their documents up to this number of spans and contents together;
#: each takes about 100 bytes.
BROADCAST_SPANS = 500_000
#: Code points of a text that are read to find one place in it.
BLOCK = 2048

SPANS = "array<struct<start:int,end:int,nr:int,kind:string>>"


def blob_id(text: Column) -> Column:
    """The address of a content; NULL is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def running(items: Column, add: Callable[[Column, Column], Column]) -> Column:
    """The array's running totals by ``add``, which is associative: n log n steps for n items.

    Each step adds the item 1, 2, 4, ... places before, so no array grows item by item.
    """
    steps = F.array(*(F.lit(1 << k) for k in range(31)))
    return F.aggregate(
        steps,
        items,
        lambda now, step: F.when(
            step < F.size(now),
            F.transform(now, lambda x, i: F.when(i >= step, add(F.get(now, i - step), x)).otherwise(x)),
        ).otherwise(now),
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spans(text: Column, rule: Rule, nr: int) -> Column:
    """Where a rule matches, leftmost and without overlap, in code points, end exclusive.

    The lengths of the matches and of what lies between them add up to the places.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    long_enough = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    sizes = F.transform(
        F.arrays_zip(gaps.alias("gap"), found.alias("hit"), long_enough.alias("part")),
        lambda x: F.struct(
            (F.char_length(x.gap) + F.coalesce(F.char_length(x.hit), F.lit(0))).alias("end"),
            F.char_length(x.hit).alias("size"),
            F.char_length(x.part).alias("part"),
        ),
    )
    ends = running(
        sizes, lambda a, b: F.struct((a.end + b.end).alias("end"), b["size"].alias("size"), b.part.alias("part"))
    )
    place = F.transform(
        F.filter(ends, lambda x: x.part >= rule.least),
        lambda x: F.struct(
            (x.end - x["size"]).alias("start"),
            x.end.alias("end"),
            F.lit(nr).alias("nr"),
            F.lit(rule.kind).alias("kind"),
        ),
    )
    none = F.expr(f"cast(array() as {SPANS})")
    return F.when(text.rlike(rule.hint or rule.pattern), place).otherwise(none)


def findings(text: Column, rules=RULES) -> Column:
    """All spans of all rules, by start, then in the order of the rules."""
    every = F.concat(*(spans(text, rule, nr) for nr, rule in enumerate(rules)))
    return F.array_sort(every, lambda a, b: F.when(a.start != b.start, a.start - b.start).otherwise(a.nr - b.nr))


class BlobLedger:
    """Which contents were scanned by which rule versions, and what was found in them.

    A folder of batches, one row per content and rule, with the spans. A batch scans each
    content once, however many paths and versions hold it, and only by the rules that no
    earlier batch applied to it. Writing a batch again replaces it (see ``BatchFolder``).
    """

    rows = f"blob string, rule string, spans {SPANS}"
    schema = f"{rows}, batch string"

    def __init__(self, spark: SparkSession, path: str, rules=RULES):
        self.spark, self.path, self.rules = spark, path.rstrip("/"), tuple(rules)
        self.batches = BatchFolder(spark, path, self.rows)

    def scan(self, batch: str, contents: DataFrame) -> DataFrame:
        """Add the unseen among ``contents`` (blob, text) and return their findings: blob, spans.

        The result has a row for each blob of ``contents``. Of the ledger only these blobs are
        grouped. A text of any length is scanned whole, in n log n steps for n findings.
        """
        earlier = not self.batches.names().filter(F.col("batch") != batch).isEmpty()
        # copies of a content meet in one row; each task merges its own copies first
        new = contents.groupBy("blob").agg(F.first("text").alias("text"))
        none = F.array().cast("array<string>")
        if earlier:
            ids = stored(contents.select("blob").distinct(), "blobs")
            known = self.batches.read().filter(F.col("batch") != batch).join(ids, "blob", "left_semi")
            seen = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
            new = new.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", none))
        else:
            new = new.withColumn("seen", none)
        left = [r.key for r in self.rules]
        new = new.filter(F.size(F.array_except(F.array(*map(F.lit, left)), F.col("seen"))) > 0)
        text = F.coalesce("text", F.lit(""))
        scanned = F.array(
            *(
                F.when(
                    ~F.array_contains("seen", rule.key),
                    F.struct(F.lit(rule.key).alias("rule"), spans(text, rule, nr).alias("spans")),
                )
                for nr, rule in enumerate(self.rules)
            )
        )
        rows = new.select("blob", F.explode(F.filter(scanned, lambda x: x.isNotNull())).alias("x"))
        self.batches.write(batch, rows.select("blob", "x.rule", "x.spans"))
        order = F.array_sort("spans", lambda a, b: F.when(a.start != b.start, a.start - b.start).otherwise(a.nr - b.nr))
        every = self.batches.read().filter(F.col("rule").isin(left))
        if earlier:
            every = every.join(ids, "blob", "left_semi")
        return (
            every.groupBy("blob")
            .agg(F.flatten(F.collect_list("spans")).alias("spans"))
            .select("blob", order.alias("spans"))
        )


def scan_versions(ledger: BlobLedger, batch: str, versions: DataFrame, text_col: str = "text") -> DataFrame:
    """The versions with the spans of their content: all columns but the text, and blob, spans.

    NULL text is the empty content. A path may come any number of times, with any versions.
    Columns of the versions that are called blob or spans give way to the new ones.
    """
    own = [c for c in versions.columns if c not in (text_col, "blob", "spans")]
    named = versions.select(*own, blob_id(versions[text_col]).alias("blob"), versions[text_col].alias("_text"))
    found = ledger.scan(batch, named.select("blob", F.col("_text").alias("text")))
    return named.drop("_text").join(found, "blob", "left").select(*own, "blob", "spans")


def joined(spans_col: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    each = F.transform(
        spans_col, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    )
    return F.array_join(each, ",")


def masked(text: Column, spans_col: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans are one.

    ``spans_col`` is ordered by start. The text is cut into blocks once, and what is kept is
    taken from them, as a place in a long text is only found by reading up to it.
    """

    def between(blocks: Column, start: Column, end: Column) -> Column:
        """The text from start to end, from the blocks it lies in."""
        first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
        parts = F.transform(
            F.sequence(first, last),
            lambda b: F.substring(
                F.get(blocks, b), F.greatest(start - b * BLOCK, F.lit(0)) + 1, F.least(end - b * BLOCK, F.lit(BLOCK))
                - F.greatest(start - b * BLOCK, F.lit(0))
            ),
        )
        return F.when(end > start, F.array_join(parts, "")).otherwise("")

    def keep(blocks: Column) -> Column:
        reach = running(F.transform(spans_col, lambda s: s.end), F.greatest)

        def rest(reached: Column) -> Column:
            before = F.transform(
                spans_col,
                lambda s, i: F.struct(
                    F.when(i > 0, F.get(reached, i - 1)).otherwise(0).alias("at"), s.start.alias("start")
                ),
            )
            cut = F.transform(
                F.filter(before, lambda s: s.start >= s["at"]),
                lambda s: F.concat(between(blocks, s["at"], s.start), F.lit(mark)),
            )
            tail = between(blocks, F.element_at(reached, -1), F.char_length(text))
            return F.concat(F.array_join(cut, ""), tail)

        return bound(reach, rest)

    done = bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), keep)
    return F.when(F.size(spans_col) > 0, done).otherwise(text)


def mask_documents(
    ledger: BlobLedger, batch: str, docs: DataFrame, text_col: str = "text", length_col: str = "n_chars"
) -> DataFrame:
    """The rows of ``docs`` with every span of their text masked, all columns in their order.

    ``length_col``, if there is one, is the new length where the text changed. Only contents
    with findings are joined; they are broadcast up to BROADCAST_SPANS spans in all.
    """
    whole = docs.select(F.struct(*docs.columns).alias("row"), blob_id(docs[text_col]).alias("blob"))
    found = ledger.scan(batch, whole.select("blob", F.col("row")[text_col].alias("text")))
    found = stored(found.filter(F.size("spans") > 0), "findings")
    few = (found.agg(F.sum(F.size("spans") + 1)).first()[0] or 0) <= BROADCAST_SPANS
    held = whole.join(F.broadcast(found) if few else found, "blob", "left")
    changed = F.col("spans").isNotNull()
    text = F.when(changed, masked(F.col("row")[text_col], F.col("spans"))).otherwise(F.col("row")[text_col])

    def column(name: str) -> Column:
        if name == text_col:
            return text.alias(name)
        if name == length_col:
            kind = docs.schema[name].dataType
            return F.when(changed, F.char_length(text).cast(kind)).otherwise(F.col("row")[name]).alias(name)
        return F.col("row")[name].alias(name)

    return held.select(*map(column, docs.columns))
