"""Secrets in texts, in SQL functions only.

Patterns find assignments, access keys and long hexadecimal runs. Beyond those, candidate
strings are judged by the Shannon entropy of a window that slides over them. The window's
character counts change by one character in and one out, and the entropy with them: a window
of w characters has entropy log2(w) - sum(c * log2(c)) / w over its counts c, and only two
terms of the sum move. Each character class has a threshold of its own. What the allow-list
names, such as placeholders and runs of the alphabet, is cut out and the rest judged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.quality import bound

# The patterns of the base kinds, in the order of their names.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_CHARS = 6
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
# A run of token characters. Possessive: where it ends, no shorter one is tried.
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}+"
ALLOWED = (
    r"(?i)example|placeholder|sample|dummy|changeme|redacted|xxxx|0{6}|1{6}|"
    r"012345|123456|987654|abcdef|qwerty|"
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
)
# An allowed word takes letters and digits beside it with it, a window of them on either side.
EXCUSED = rf"[A-Za-z0-9]{{0,{WINDOW}}}(?:{ALLOWED})[A-Za-z0-9]{{0,{WINDOW}}}"
_SCALE = 1 << 20


@dataclass(frozen=True)
class CharacterClass:
    """Candidates that match ``pattern`` are reported from ``bits`` of entropy a character on."""

    name: str
    pattern: str
    bits: float


CLASSES = (
    CharacterClass("hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.0),
    CharacterClass("mixed", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", 3.8),
    CharacterClass("one_case", r"^(?=.*[0-9].*[0-9].*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]+$", 3.7),
)


def _running(values: Column, join, none: int) -> Column:
    """Running results of an associative ``join`` over an array, up to and with each place.

    Folding into one array would copy it at each step, so the array is folded in parts of about
    the square root of its length, and then the results of the parts.
    """

    def folded(array: Column, last: Column) -> Column:
        empty = F.struct(F.array().cast("array<int>").alias("rows"), last.alias("at"))

        def step(done: Column, value: Column) -> Column:
            now = join(done["at"], value)
            return F.struct(F.concat(done["rows"], F.array(now)).alias("rows"), now.alias("at"))

        return F.aggregate(array, empty, step)["rows"]

    def parts(x: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(x))).cast("int")
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1)), F.greatest(width, F.lit(1))), lambda s: s <= F.size(x))
        return F.transform(starts, lambda s: folded(F.slice(x, s, width), F.lit(none)))

    def combined(own: Column) -> Column:
        totals = folded(F.transform(own, lambda part: F.element_at(part, -1)), F.lit(none))

        def moved(before: Column) -> Column:
            def part_moved(part: Column, k: Column) -> Column:
                return F.transform(part, lambda value: join(F.coalesce(F.get(before, k - 1), F.lit(none)), value))

            return F.flatten(F.transform(own, part_moved))

        return bound(totals, moved)

    return bound(values, lambda x: bound(parts(x), combined))


def _placed(between: Column, hits: Column) -> Column:
    """Structs ``start, end`` of ``hits``, given the texts between them: these come first and last."""
    lengths = F.flatten(F.transform(hits, lambda hit, k: F.array(F.length(F.get(between, k)), F.length(hit))))

    def ends(sums: Column) -> Column:
        return F.transform(
            hits, lambda hit, k: F.struct(F.get(sums, 2 * k).alias("start"), F.get(sums, 2 * k + 1).alias("end"))
        )

    return bound(_running(lengths, lambda a, b: a + b, 0), ends)


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """Non-overlapping matches from the left: texts ``between`` them, ``hits`` and the ``values`` of ``group``."""
    return F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )


_HITS = "array<struct<start:int,end:int,hit:string>>"


def matches(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Non-overlapping matches from the left, as structs ``start, end, hit`` in code points.

    Those whose ``group`` is shorter than ``least`` are dropped after matching.
    """

    def rows(x: Column) -> Column:
        def row(place: Column, k: Column) -> Column:
            return F.struct(place["start"], place["end"], F.get(x["hits"], k).alias("hit"), F.get(x["values"], k).alias("value"))

        every = F.transform(_placed(x["between"], x["hits"]), row)
        kept = F.filter(every, lambda r: F.length(r["value"]) >= least)
        return F.transform(kept, lambda r: F.struct(r["start"], r["end"], r["hit"]))

    return F.when(text.rlike(pattern), bound(_found(text, pattern, group), rows)).otherwise(F.array().cast(_HITS))


def blanked(text: Column, pattern: str, group: int, least: int) -> Column:
    """``text`` with blanks for the matches whose ``group`` has ``least`` characters."""

    def joined(x: Column) -> Column:
        def part(before: Column, k: Column) -> Column:
            hit, value = F.get(x["hits"], k), F.get(x["values"], k)
            blank = F.when(F.length(value) >= least, F.repeat(F.lit(" "), F.length(hit))).otherwise(hit)
            return F.concat(before, F.coalesce(blank, F.lit("")))

        return F.array_join(F.transform(x["between"], part), "")

    return F.when(text.rlike(pattern), bound(_found(text, pattern, group), joined)).otherwise(text)


def _weight(count: int) -> int:
    """c * log2(c) as a whole number, so that sums do not depend on their order."""
    return round(count * math.log2(count) * _SCALE) if count else 0


def dense_span(token: Column, bits: Column, window: int = WINDOW) -> Column:
    """Struct ``first, last`` of the first and last window with ``bits`` of entropy, or nulls.

    One pass over the characters. ``held`` are those of the window, ``total`` the sum of their
    counts' weights; the counts of the one that enters and the one that leaves are all that move.
    """
    weights = F.array(*[F.lit(_weight(c)).cast("bigint") for c in range(window + 2)])
    # Entropy >= bits, in whole numbers. Bound, or each step would work out the token's class anew.
    most = F.floor(F.lit(float(_SCALE)) * window * (F.lit(math.log2(window)) - bits) + 1e-6)
    return bound(most, lambda limit: _dense_span(token, limit, weights, window))


def _dense_span(token: Column, most: Column, weights: Column, window: int) -> Column:
    def moved(state: Column, entering: Column) -> Column:
        held = state["held"]
        full = F.size(held) == window
        leaving = F.when(full, F.get(held, F.lit(0)))
        kept = F.when(full, F.slice(held, 2, window - 1)).otherwise(held)

        def count(of: Column) -> Column:
            return F.size(F.filter(held, lambda c: c == of))

        def gain(n: Column, by: int) -> Column:
            return F.get(weights, n + by) - F.get(weights, n)

        change = F.when(full & (leaving == entering), F.lit(0).cast("bigint")).otherwise(
            gain(count(entering), 1) + F.when(full, gain(count(leaving), -1)).otherwise(F.lit(0).cast("bigint"))
        )
        total = state["total"] + change
        # The window that ends here starts at ``at``.
        at = state["at"] + 1
        dense = (at >= 0) & (total <= most)
        return F.struct(
            F.concat(kept, F.array(entering)).alias("held"),
            at.alias("at"),
            total.alias("total"),
            F.when(dense & state["first"].isNull(), at).otherwise(state["first"]).alias("first"),
            F.when(dense, at).otherwise(state["last"]).alias("last"),
        )

    nothing = F.lit(None).cast("int")
    start = F.struct(
        F.array().cast("array<string>").alias("held"),
        F.lit(-window).alias("at"),
        F.lit(0).cast("bigint").alias("total"),
        nothing.alias("first"),
        nothing.alias("last"),
    )
    return F.aggregate(
        F.split(token, ""),
        start,
        moved,
        lambda state: F.struct(state["first"].alias("first"), state["last"].alias("last")),
    )


def entropy_spans(text: Column, window: int = WINDOW) -> Column:
    """Dense stretches of candidates, from the first to the last dense window of each.

    A candidate is judged in the parts that access keys, hexadecimal runs and allowed words
    leave of it, each by its own class or, if it has none, by the candidate's.
    """
    none = F.array().cast("array<struct<start:int,end:int>>")

    def bits_of(token: Column) -> Column:
        bits = F.lit(None).cast("double")
        for kind in reversed(CLASSES):
            bits = F.when(token.rlike(kind.pattern), kind.bits).otherwise(bits)
        return bits

    def left_by(pattern: str):
        """Of a run, the parts between what matches, as long as a window at least."""
        return lambda run: left_of(run, pattern)

    def left_of(run: Column, pattern: str) -> Column:
        def parts(x: Column) -> Column:
            # A part starts where the match before it ends.
            def row(part: Column, k: Column) -> Column:
                start = run["start"] + F.coalesce(F.get(x["places"], k - 1)["end"], F.lit(0))
                return F.struct(start.alias("start"), part.alias("hit"), run["bits"].alias("bits"))

            return F.filter(F.transform(x["between"], row), lambda r: F.length(r["hit"]) >= window)

        def placed(x: Column) -> Column:
            return bound(F.struct(x["between"], _placed(x["between"], x["hits"]).alias("places")), parts)

        whole = F.array(F.struct(run["start"], run["hit"], run["bits"]))
        # Where no allowed word is, none needs looking for with what surrounds it.
        plain = ALLOWED if pattern == EXCUSED else pattern
        return F.when(run["hit"].rlike(plain), bound(_found(run["hit"], pattern), placed)).otherwise(whole)

    def judged(part: Column) -> Column:
        bits = F.coalesce(bits_of(part["hit"]), part["bits"])

        def located(span: Column) -> Column:
            start = part["start"] + span["first"]
            return F.struct(start.alias("start"), (part["start"] + span["last"] + window).alias("end"))

        return bound(dense_span(part["hit"], bits, window), located)

    candidates = F.transform(
        matches(text, CANDIDATE),
        lambda c: F.struct(c["start"].alias("start"), c["hit"].alias("hit"), bits_of(c["hit"]).alias("bits")),
    )
    parts = F.filter(candidates, lambda c: c["bits"].isNotNull())
    for pattern in (f"{ACCESS}|{HEX}", EXCUSED):
        parts = F.flatten(F.transform(parts, left_by(pattern)))
    found = F.filter(F.transform(parts, judged), lambda s: s["start"].isNotNull())
    return F.when(text.rlike(CANDIDATE), found).otherwise(none)


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``all_spans``: arrays of structs ``start, kind_no, end, kind``
    in order of start and kind, in code points, end exclusive, and counts ``n_assign``, ``n_access``,
    ``n_hex`` and ``n_entropy``. These replace columns of such names.

    Entropy is judged in what the base spans leave of the text, so nothing is found twice (but
    where two base spans overlap, what the shorter one leaves may be judged). Null and empty texts
    have no spans. The text is searched whole, in time that grows with its length.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    found = docs.withColumns(
        {
            "__assign": matches(text, ASSIGN, 1, ASSIGN_CHARS),
            "__access": matches(text, ACCESS),
            "__hex": matches(text, HEX),
            "__entropy": bound(blanked(text, ASSIGN, 1, ASSIGN_CHARS), lambda rest: entropy_spans(rest)),
        }
    )

    def tagged(kind: str) -> Column:
        no = KINDS.index(kind)
        return F.transform(
            f"__{kind}",
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    spans = {
        "base_spans": F.sort_array(F.concat(*[tagged(kind) for kind in KINDS[:3]])),
        "all_spans": F.sort_array(F.concat(*[tagged(kind) for kind in KINDS])),
    }
    counts = {f"n_{kind}": F.size(f"__{kind}").cast("bigint") for kind in KINDS}
    return found.withColumns({**spans, **counts}).drop(*[f"__{kind}" for kind in KINDS])


def spans_text(spans: str) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
