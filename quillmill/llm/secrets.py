r"""Secret scans: base patterns and sliding-window entropy [native].

Base spans come from three patterns. Besides, runs of a character class (an alphabet
with a least length) are candidate strings: a window slides over each and its Shannon
entropy is kept up to date from counts, one character in and one out a step. In
whole numbers, S = sum f(count) with f(c) = round(2**20 * c * log2(c)) changes by
two differences of f a step, and the entropy is log2(W) - S / (W * 2**20); nothing is
summed anew and nothing drifts. The counts are packed, five bits each, into a few longs,
so a step costs the same whatever the alphabet. A candidate whose best window reaches
the class's threshold is a span, unless an allow pattern matches it or a base span
overlaps it.

Positions are running sums of the lengths of matches and of the texts between them, by
doubling: round k adds what stands 2**k places before, so n matches take log2(n)
rounds. Overlaps with base spans are found by binary search. The work of a text is
its length plus n * log(n).

Spans are code points, end exclusive.

Defined cases: a null text is empty and has no spans; repeated rows give repeated
results; a text may be of any length; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind, pattern (Java), group whose length counts, least length.
BASE_PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: A cheaper pattern that every text with a kept match of the kind contains.
_CAN_MATCH = {
    "assign": r"(?i)(?:pass|secret|token|api_?key)",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
}
_SCALE = 1 << 20


@dataclass(frozen=True)
class CharClass:
    name: str
    alphabet: str
    least: int  # characters a candidate has at least
    window: int
    bits: float  # entropy of the best window from which a candidate is reported
    must: tuple[str, ...]  # patterns that a candidate has to contain

    @property
    def pattern(self) -> str:
        return "[" + "".join("\\" + c if c in "+/-_=" else c for c in self.alphabet) + "]{%d,}" % self.least

    @property
    def most(self) -> int:
        """The largest S at which the entropy is not below bits."""
        return math.floor((math.log2(self.window) - self.bits) * self.window * _SCALE)


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_mixed", _DIGITS + _LOWER + _LOWER.upper() + "+/_=-", 20, 20, 3.83, ("[0-9]", "[a-z]", "[A-Z]")),
    CharClass("entropy_hex", _DIGITS + "ABCDEF", 20, 20, 3.03, ("[0-9]", "[A-F]")),
    CharClass("entropy_lower", _DIGITS + _LOWER, 20, 20, 3.6, ("[0-9].*[0-9]", "[g-z]")),
    CharClass("entropy_upper", _DIGITS + _LOWER.upper(), 20, 20, 3.6, ("[0-9].*[0-9]", "[G-Z]")),
)
#: Candidates that match one of these are not reported.
ALLOW = ("(?i)example", "(?i)placeholder", "0123456789", "(?i)abcdefgh")


_FOUND = "array<struct<start:int,end:int,kind:string,match:string>>"


def _left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def running_sums(sizes: Column) -> Column:
    """The sums of an array's first one, two, ... numbers, in log2(n) rounds."""
    rounds = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: _left(F.lit(1), k) < F.size(sizes))
    return F.aggregate(
        rounds, sizes, lambda sums, k: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - _left(F.lit(1), k)), F.lit(0)))
    )


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """array of (start, end, kind, match) of the kept matches: texts between matches and matches add up to positions."""

    def placed(m: Column) -> Column:
        """m: the matches, the lengths of their groups, and the texts between them."""
        sizes = F.transform(m["whole"], F.length)
        ends = running_sums(F.zip_with(sizes, F.slice(m["gaps"], F.lit(1), F.size(sizes)), lambda a, b: a + F.length(b)))
        rows = F.zip_with(
            F.arrays_zip(m["whole"].alias("match"), m["kept"].alias("kept")), ends,
            lambda x, end: F.struct((end - F.length(x["match"])).alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["match"].alias("match"), x["kept"].alias("kept")),
        )
        return F.transform(
            F.filter(rows, lambda r: r["kept"] >= least), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["kind"].alias("kind"), r["match"].alias("match"))
        )

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    made = F.struct(whole.alias("whole"), F.transform(kept, F.length).alias("kept"), F.split(text, pattern, -1).alias("gaps"))
    # an array of one struct names the parts, so that each is computed once
    return F.transform(F.array(made), placed)[0]


def base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = next(p[1:] for p in BASE_PATTERNS if p[0] == kind)
    return F.when(text.rlike(_CAN_MATCH[kind]), _spans(text, kind, pattern, group, least)).otherwise(F.array().cast(_FOUND))


#: Bits of a packed count, and counts in a long.
_BITS, _PER_LONG = 5, 12


def least_window_sum(candidate: Column, cls: CharClass) -> Column:
    """The least S over all windows of the candidate, by incremental counts."""
    if cls.window >= 1 << _BITS:
        raise ValueError(f"a window has less than {1 << _BITS} characters")
    f = [0] + [round(_SCALE * c * math.log2(c)) for c in range(1, cls.window + 2)]
    grows = F.array(*[F.lit(b - a).cast("long") for a, b in zip(f[:-1], f[1:], strict=True)])  # from a count to one more
    # where a character's count is: its long in the upper bits, its first bit in the lower six
    places = F.array(*[F.lit(i // _PER_LONG << 6 | i % _PER_LONG * _BITS) for i in range(len(cls.alphabet))])
    ids = F.transform(F.split(candidate, ""), lambda c: F.get(places, F.call_function("instr", F.lit(cls.alphabet), c) - 1))
    longs = -(-len(cls.alphabet) // _PER_LONG)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    bit = lambda i: i.bitwiseAND(63)

    def count(words: Column, i: Column) -> Column:
        return _right(F.get(words, _right(i, F.lit(6))), bit(i)).bitwiseAND(31).cast("int")

    def step(acc: Column, at: Column) -> Column:
        new = F.get(acc["ids"], at)
        old = F.when(at >= cls.window, F.get(acc["ids"], at - cls.window)).otherwise(F.lit(-1))
        gone = F.when(old >= 0, F.get(grows, count(acc["words"], old) - 1)).otherwise(zero)
        moved = F.when(old == new, zero).otherwise(F.get(grows, count(acc["words"], new)) - gone)
        total = acc["total"] + moved
        one = lambda i, k: F.when(_right(i, F.lit(6)) == k, _left(F.lit(1).cast("long"), bit(i))).otherwise(zero)
        words = F.array(*[acc["words"][k] + one(new, k) - one(old, k) for k in range(longs)])
        best = F.when(at >= cls.window - 1, F.least(acc["best"], total)).otherwise(acc["best"])
        return F.struct(acc["ids"].alias("ids"), words.alias("words"), total.alias("total"), best.alias("best"))

    begin = F.struct(ids.alias("ids"), F.array(*[zero] * longs).alias("words"), zero.alias("total"), none.alias("best"))
    return F.aggregate(F.sequence(F.lit(0), F.length(candidate) - 1), begin, step, lambda acc: acc["best"])


def _overlaps(spans: Column, start: Column, end: Column) -> Column:
    """True if one of the spans (of one kind, in order) overlaps: the last that begins before `end` ends behind `start`."""
    bounds = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))  # how many begin before `end`

    def halve(b: Column, _: Column) -> Column:
        middle = F.floor((b["low"] + b["high"]) / 2).cast("int")
        before = F.get(spans, middle)["start"] < end
        open_ = b["low"] < b["high"]
        return F.struct(
            F.when(open_ & before, middle + 1).otherwise(b["low"]).alias("low"), F.when(open_ & ~before, middle).otherwise(b["high"]).alias("high")
        )

    rounds = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: _left(F.lit(1), k) <= F.size(spans))
    return F.aggregate(rounds, bounds, halve, lambda b: F.coalesce(F.get(spans, b["low"] - 1)["end"] > start, F.lit(False)))


def entropy_spans(text: Column, cls: CharClass, bases: list[Column]) -> Column:
    """The class's candidates of high entropy; bases: the base spans of each kind."""

    def suspicious(s: Column) -> Column:
        ok = F.lit(True)
        for pattern in cls.must:
            ok = ok & s["match"].rlike(pattern)
        for pattern in ALLOW:
            ok = ok & ~s["match"].rlike(pattern)
        for spans in bases:
            ok = ok & ~_overlaps(spans, s["start"], s["end"])
        return F.when(ok, least_window_sum(s["match"], cls) <= cls.most).otherwise(F.lit(False))

    runs = _spans(text, cls.name, cls.pattern, 0, cls.least)
    return F.when(text.rlike(cls.pattern), F.filter(runs, suspicious)).otherwise(F.array().cast(_FOUND))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple[CharClass, ...] = CLASSES) -> DataFrame:
    """id, base and spans: arrays of (start, end, kind) by start, then kind as listed."""
    kinds = [p[0] for p in BASE_PATTERNS] + [c.name for c in classes]

    def ranked(spans: Column, rank: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    def ordered(found: list[Column]) -> Column:
        names = F.array(*[F.lit(k) for k in kinds])
        every = F.array_sort(F.concat(*[ranked(spans, i) for i, spans in enumerate(found)]))
        return F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["rank"]).alias("kind")))

    text = F.col("_text")
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    based = rows.withColumns({f"_{p[0]}": base_spans(text, p[0]) for p in BASE_PATTERNS})
    bases = [F.col(f"_{p[0]}") for p in BASE_PATTERNS]
    every = based.withColumns({f"_{c.name}": entropy_spans(text, c, bases) for c in classes})
    return every.select(id_col, ordered(bases).alias("base"), ordered(bases + [F.col(f"_{c.name}") for c in classes]).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
