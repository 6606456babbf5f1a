"""Secrets in texts: fixed patterns and sliding-window Shannon entropy, built-in functions only.

Everything happens within a row: no shuffle, however the rows are dealt.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words before an assigned secret; their letters match in either case (fixed values).
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_?key")
_KEY = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ASSIGN_WORDS)
ASSIGN = rf"""({_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
# A run is taken whole, so the least length in the pattern drops what a later check would.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"

#: Characters of a window, and the parts of a bit that entropies are counted in.
WINDOW, UNIT = 20, 1_000_000
#: Characters that a window slides over in one go.
SEGMENT = 512


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``alphabet`` are candidates; a window of ``least_bits`` per character is random."""

    kind: str
    alphabet: str
    least_bits: float
    #: Patterns that a candidate must all hold.
    needs: tuple[str, ...]


CLASSES = (
    CharacterClass("entropy_hex", "0-9a-fA-F", 2.9, ("[0-9]", "[a-fA-F]")),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 3.8, ("[0-9]", "[a-z]", "[A-Z]")),
)
#: Candidates that hold one of these are no secrets (fixed values).
ALLOWED = (
    "(?i)example",
    "(?i)placeholder",
    "(?i)your[_-]",
    "(?i)0123456789abcdef",
    "(?i)abcdefghijklmnop",
    "(?i)deadbeef",
    "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
    "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "d41d8cd98f00b204e9800998ecf8427e",
)
KINDS = ("assign", "access", "hex", *[c.kind for c in CLASSES])
#: Random keys in letters of one case and digits, as base32: for redaction, beside ``CLASSES``.
ONE_CASE = (
    CharacterClass("entropy_lower", "a-z0-9", 3.5, ("[0-9].*[0-9].*[0-9]", "[a-z]")),
    CharacterClass("entropy_upper", "A-Z0-9", 3.5, ("[0-9].*[0-9].*[0-9]", "[A-Z]")),
)
#: What ends a piece of a candidate, if the allow-list is to look at pieces.
PIECE_ENDS = "/="
_SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"


def surplus(count: int) -> int:
    """``count * log2(count)`` in units: what a character seen so often takes from a window's entropy."""
    return round(count * math.log2(count) * UNIT) if count else 0


def most_surplus(bits: float, window: int) -> int:
    """A window has at least ``bits`` of entropy per character up to this sum over its characters."""
    return math.floor(window * (math.log2(window) - bits) * UNIT)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs (start, match), in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.aggregate(
        F.arrays_zip(found.alias("found"), F.slice(gaps, 1, F.size(found)).alias("gap")),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,match:string>>").alias("out")),
        lambda state, item: F.struct(
            (state["at"] + F.length(item["gap"]) + F.length(item["found"])).alias("at"),
            F.concat(
                state["out"],
                F.array(F.struct((state["at"] + F.length(item["gap"])).alias("start"), item["found"].alias("match"))),
            ).alias("out"),
        ),
    )
    return F.when(F.size(found) > 0, start["out"]).otherwise(
        F.array().cast("array<struct<start:bigint,match:string>>")
    )


def _spans(found: Column, rank: int) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), (m["start"] + F.length(m["match"])).alias("end")
        ),
    )


def random_parts(candidate: Column, start: Column, of: CharacterClass, rank: int, window: int) -> Column:
    """Spans of a candidate that windows of enough entropy cover, joined where they touch.

    The window moves by one character: the count of the one that enters goes up and that
    of the one that leaves goes down, and the sum of surpluses changes by those two only.
    Both counts are read off the characters the two windows share.
    """
    steps = F.array(*[F.lit(surplus(n + 1) - surplus(n)) for n in range(window)])
    limit = F.lit(most_surplus(of.least_bits, window))
    size = F.length(candidate)

    def times(char: Column, begin: Column, many: Column) -> Column:
        part = F.substr(candidate, begin, many)
        return F.length(part) - F.length(F.replace(part, char, F.lit("")))

    def slide(state: Column, end: Column) -> Column:
        """``end``: the last character of the window, counted from 1."""
        first = end - window + 1
        enters = F.substr(candidate, end, F.lit(1))
        shared = F.greatest(first, F.lit(1))
        gained = F.element_at(steps, times(enters, shared, end - shared) + 1)
        leaves = F.substr(candidate, F.greatest(first - 1, F.lit(1)), F.lit(1))
        lost = F.when(first > 1, F.element_at(steps, times(leaves, shared, end - shared) + 1)).otherwise(0)
        total = state["total"] - lost + gained
        hit = (first >= 1) & (total <= limit)
        joins = hit & (state["to"] >= first - 1) & (state["to"] > 0)
        closes = hit & ~joins & (state["to"] > 0)
        return F.struct(
            total.alias("total"),
            F.when(hit & ~joins, first).otherwise(state["from"]).alias("from"),
            F.when(hit, end).otherwise(state["to"]).alias("to"),
            F.when(closes, F.concat(state["out"], F.array(_part(state)))).otherwise(state["out"]).alias("out"),
        )

    def _part(state: Column) -> Column:
        return F.struct(
            (start + state["from"] - 1).cast("bigint").alias("start"),
            F.lit(rank).alias("rank"),
            (start + state["to"]).cast("bigint").alias("end"),
        )

    zero = F.lit(0)
    return F.aggregate(
        F.sequence(F.lit(1), size),
        F.struct(zero.alias("total"), zero.alias("from"), zero.alias("to"), F.array().cast(_SPAN).alias("out")),
        slide,
        lambda state: F.when(state["to"] > 0, F.concat(state["out"], F.array(_part(state)))).otherwise(state["out"]),
    )


def _without_allowed(m: Column, allowed: tuple[str, ...]) -> Column:
    """What is left of a candidate on both sides of its allowed pieces, as structs (start, match).

    Pieces end after a character of ``PIECE_ENDS``; neighbours that are not allowed stay together.
    """
    empty = F.array().cast("array<struct<start:bigint,match:string>>")
    zero = F.struct(
        m["start"].cast("bigint").alias("at"), m["start"].cast("bigint").alias("from"), F.lit("").alias("open"), empty.alias("out")
    )

    def closed(s: Column) -> Column:
        done = F.struct(s["from"].alias("start"), s["open"].alias("match"))
        return F.when(s["open"] != "", F.concat(s["out"], F.array(done))).otherwise(s["out"])

    def step(s: Column, piece: Column) -> Column:
        passed = F.lit(False)
        for pattern in allowed:
            passed = passed | F.regexp_like(F.rtrim(piece, F.lit(PIECE_ENDS)), F.lit(pattern))
        end = s["at"] + F.length(piece)
        return F.struct(
            end.alias("at"),
            F.when(passed, end).otherwise(s["from"]).alias("from"),
            F.when(passed, "").otherwise(F.concat(s["open"], piece)).alias("open"),
            F.when(passed, closed(s)).otherwise(s["out"]).alias("out"),
        )

    pieces = F.regexp_extract_all(m["match"], F.lit(f"[^{PIECE_ENDS}]*[{PIECE_ENDS}]+|[^{PIECE_ENDS}]+"), F.lit(0))
    return F.aggregate(pieces, zero, step, closed)


def _entropy_spans(
    text: Column, of: CharacterClass, rank: int, window: int, allowed: tuple[str, ...], pieces: bool = False
) -> Column:
    def suspect(m: Column) -> Column:
        kept = F.lit(True)
        for pattern in of.needs:
            kept = kept & F.regexp_like(m["match"], F.lit(pattern))
        for pattern in () if pieces else allowed:
            kept = kept & ~F.regexp_like(m["match"], F.lit(pattern))
        return kept

    found = matches(text, f"[{of.alphabet}]{{{window},}}")
    if pieces:
        found = F.flatten(F.transform(found, lambda m: _without_allowed(m, allowed)))
        found = F.filter(found, lambda m: F.length(m["match"]) >= window)
    candidates = F.filter(found, suspect)
    return F.flatten(
        F.transform(
            candidates,
            lambda m: F.when(
                F.length(m["match"]) <= SEGMENT, random_parts(m["match"], m["start"], of, rank, window)
            ).otherwise(_by_segments(m, of, rank, window)),
        )
    )


def _by_segments(m: Column, of: CharacterClass, rank: int, window: int) -> Column:
    """``random_parts`` of a long candidate in time that grows with its length, not its square.

    Finding the n-th character of a text takes n steps, so it is cut into segments first, each
    with the first characters of the next one: every window lies in the segment it begins in.
    Spans that touch are joined.
    """
    size = max(SEGMENT, window)
    cut = F.regexp_extract_all(m["match"], F.lit(f".{{1,{size}}}"), F.lit(0))
    # An array of one element binds what was cut, so that it isn't cut again at every step.
    found = F.flatten(F.flatten(F.transform(F.array(cut), lambda parts: F.transform(
        F.arrays_zip(parts.alias("own"), F.slice(parts, F.lit(2), F.size(parts)).alias("next"), F.sequence(F.lit(0), F.size(parts) - 1).alias("nth")),
        lambda p: random_parts(
            F.concat(p["own"], F.coalesce(F.left(p["next"], F.lit(window - 1)), F.lit(""))),
            m["start"] + p["nth"] * size, of, rank, window,
        ),
    ))))

    def join(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), last["rank"].alias("rank"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(touches, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(found, F.array().cast(_SPAN), join)


def scan(
    docs: DataFrame,
    text: str = "text",
    *,
    window: int = WINDOW,
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
    pieces: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` and ``base_spans``, ``secret_spans``.

    Spans are structs (start, kind, end) in code points, end exclusive, by start and then
    kind as in ``KINDS``; ``secret_spans`` adds the windows of high entropy to the fixed
    patterns, which no allow-list touches. The allow-list drops a whole candidate or, with
    ``pieces``, only the piece between ``PIECE_ENDS`` that it matches. A NULL text is read
    as empty and has none.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    assigned = F.filter(
        matches(whole, ASSIGN),
        lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGN_LEAST,
    )
    base = F.array_sort(
        F.concat(_spans(assigned, 0), _spans(matches(whole, ACCESS), 1), _spans(matches(whole, HEX), 2))
    )
    more = [_entropy_spans(whole, c, 3 + i, window, allowed, pieces) for i, c in enumerate(classes)]
    kinds = F.array(*map(F.lit, (*KINDS[:3], *[c.kind for c in classes])))

    def named(spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), F.element_at(kinds, s["rank"] + 1).alias("kind"), s["end"].alias("end")),
        )

    return (
        docs.withColumn("__base", base)
        .withColumn("__all", F.array_sort(F.concat(F.col("__base"), *more)))
        .withColumn("base_spans", named(F.col("__base")))
        .withColumn("secret_spans", named(F.col("__all")))
        .drop("__base", "__all")
    )


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each secret replaced by ``<secret>``; overlapping spans become one."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, span: Column) -> Column:
        fresh = span["start"] >= s["at"]
        before = F.substr(text, (s["at"] + 1).cast("int"), (span["start"] - s["at"]).cast("int"))
        return F.struct(
            F.greatest(s["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(s["out"], F.array(before, F.lit("<secret>")))).otherwise(s["out"]).alias("out"),
        )

    done = F.aggregate(
        spans, state, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substr(text, (s["at"] + 1).cast("int")))
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
