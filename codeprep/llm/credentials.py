"""Secrets in texts: three fixed patterns, and the Shannon entropy of sliding windows.

Everything is built-in column functions. A pattern's matches and the pieces between them give
the places of all matches, leftmost first and without overlap, counted in code points. Texts
without a match are left after one test.

A candidate string is a run of ``[A-Za-z0-9+/_=-]`` of ``WINDOW`` or more characters that holds
a digit and a letter. For every character class (lower or upper hex, alphanumeric, base64) a
window of ``WINDOW`` characters slides over the longest runs of its alphabet in it, as far as
these are candidates themselves: a key that is glued to a name, a path or ``0x`` is judged by its
own class, too. The counts of the
characters in the window are kept, and one step changes two of them and the running sum of
c * log2(c); the entropy is log2(WINDOW) - sum / WINDOW. Windows above the class's threshold
that touch, of one class or several, are one span. Candidates on the allow list (identifiers like UUIDs, dates,
addresses, plain words joined by signs, few different characters) are not reported; neither
are spans inside a span of a fixed pattern. These spans are of kind ``entropy``, the fixed
patterns' spans stay whatever the method says.

Null and empty texts have no spans. Rows stay as they are, repeated or not, with a null id or
not; further columns are kept by ``with_secrets``. Lists only grow with the matches in a text.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns and the length that a match must have, of group 2 for assign.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 6
# A run of 20 or more that begins with AKIA; a run of 24 or more: the leftmost match of the
# open pattern takes the whole run, so its length can be asked for in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

RUN = 256

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Class, its alphabet, bits per character above which a window is random.
CLASSES = (
    ("hex", "0123456789abcdef", 3.05),
    ("upper_hex", "0123456789ABCDEF", 3.05),
    ("alphanumeric", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.72),
    ("base64", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 3.85),
)
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9T_-]*$",  # date, time
    # Words and numbers joined by signs. Nothing is given back: a long run of groups that could be
    # would take the stack.
    r"^[A-Za-z]*+[0-9]*+(?:[+/_=-]++(?:[A-Za-z]++|[0-9]++))*+[+/_=-]*+$",
    r"^([0-9]+[A-Za-z]?|[A-Za-z]+[0-9]{0,4})$",  # a number with a unit, a word with a number
)

_SPAN = "array<struct<start:int,stop:int,kind:int>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _places(text: Column, pattern: str) -> Column:
    """Array of (start, word) of all matches of ``pattern``; only for texts that have one.

    Starts are running sums, first inside runs of ``RUN`` matches, then over the runs, so that
    no long array is copied for each match.
    """
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(pieces, 1, F.size(matches)),
        matches,
        lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("word")),
    )
    none = F.array().cast("array<struct<start:int,word:string>>")

    def sums(steps_of, begin):
        return F.aggregate(
            F.slice(steps_of, begin + 1, RUN),
            F.struct(F.lit(0).alias("at"), none.alias("found")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.length(x["word"])).alias("at"),
                F.concat(
                    acc["found"],
                    F.array(F.struct((acc["at"] + x["gap"]).alias("start"), x["word"].alias("word"))),
                ).alias("found"),
            ),
        )

    def after(acc, one):
        moved = F.transform(
            one["found"],
            lambda x: F.struct((acc["at"] + x["start"]).alias("start"), x["word"].alias("word")),
        )
        return F.struct(
            (acc["at"] + one["at"]).alias("at"),
            F.concat(acc["found"], F.array(moved)).alias("found"),
        )

    nothing = F.array().cast("array<array<struct<start:int,word:string>>>")

    def all_runs(bound):
        begins = F.sequence(F.lit(0), F.size(bound) - 1, F.lit(RUN))
        return F.aggregate(
            F.transform(begins, lambda begin: sums(bound, begin)),
            F.struct(F.lit(0).alias("at"), nothing.alias("found")),
            after,
            lambda acc: F.flatten(acc["found"]),
        )

    # The one-element array names the steps, so that they are computed once.
    return F.get(F.transform(F.array(steps), all_runs), F.lit(0))


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    found = _places(text, pattern)
    if keep is not None:
        found = F.filter(found, lambda x: keep(x["word"]))
    spans = F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"),
            (x["start"] + F.length(x["word"])).alias("stop"),
            F.lit(KINDS.index(kind)).alias("kind"),
        ),
    )
    return F.when(text.rlike(pattern), spans).otherwise(_none())


def _bits(count: Column) -> Column:
    """count * log2(count), 0 for 0."""
    table = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)])
    return F.get(table, count)


def _random_stretches(word: Column, alphabet: str, threshold: float) -> Column:
    """Array of (start, stop) inside ``word`` where windows reach the threshold.

    One pass over the letters that enter the window, each with the one that leaves it: the count
    of the one goes up and that of the other goes down. The last stretch is kept beside the
    finished ones, so a window costs the same however long the word is.
    """
    letters = F.split(word, "")
    before = F.concat(F.array_repeat(F.lit(None).cast("string"), WINDOW), letters)
    steps = F.zip_with(
        letters,
        F.slice(before, 1, F.size(letters)),
        lambda a, b: F.struct(
            (F.instr(F.lit(alphabet), a) - 1).alias("enters"), (F.instr(F.lit(alphabet), b) - 1).alias("leaves")
        ),
    )
    none = F.array().cast("array<struct<start:int,stop:int>>")
    state = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("at"),
        F.lit(-1).alias("start"),
        F.lit(-1).alias("stop"),
        none.alias("found"),
    )

    def last(acc):
        return F.array(F.struct(acc["start"], acc["stop"]))

    def step(acc, x):
        up, down = F.get(acc["counts"], x["enters"]), F.get(acc["counts"], x["leaves"])
        changed = (
            F.when(x["leaves"].isNull(), _bits(up + 1) - _bits(up))
            .when(x["enters"] == x["leaves"], F.lit(0.0))
            .otherwise(_bits(up + 1) - _bits(up) + _bits(down - 1) - _bits(down))
        )
        counts = F.transform(
            acc["counts"],
            lambda c, k: c + (k == x["enters"]).cast("int") - F.coalesce(k == x["leaves"], F.lit(False)).cast("int"),
        )
        total, stop = acc["total"] + changed, acc["at"] + 1
        begin = stop - WINDOW
        random = (begin >= 0) & (math.log2(WINDOW) - total / WINDOW > threshold)
        new = random & (begin > acc["stop"])
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            stop.alias("at"),
            F.when(new, begin).otherwise(acc["start"]).alias("start"),
            F.when(random, stop).otherwise(acc["stop"]).alias("stop"),
            F.when(new & (acc["stop"] >= 0), F.concat(acc["found"], last(acc))).otherwise(acc["found"]).alias("found"),
        )

    return F.aggregate(
        steps, state, step, lambda acc: F.when(acc["stop"] >= 0, F.concat(acc["found"], last(acc))).otherwise(acc["found"])
    )


def _entropy_spans(candidate: Column) -> Column:
    """Spans of kind entropy in one candidate (start, word), over the runs of every class in it."""
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def of_class(alphabet, threshold):
        word, pattern = candidate["word"], f"[{alphabet}]{{{WINDOW},}}"
        places = F.when(word.rlike(pattern), _places(word, pattern))
        runs = F.filter(
            F.coalesce(places, F.array().cast("array<struct<start:int,word:string>>")),
            lambda x: _is_candidate(x["word"]),
        )

        def in_run(run):
            return F.transform(
                _random_stretches(run["word"], alphabet, threshold),
                lambda s: F.struct(
                    (candidate["start"] + run["start"] + s["start"]).alias("start"),
                    (candidate["start"] + run["start"] + s["stop"]).alias("stop"),
                ),
            )

        return F.flatten(F.transform(runs, in_run))

    found = [of_class(alphabet, threshold) for _, alphabet, threshold in CLASSES]

    def merge(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        both = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        return F.when(
            last["stop"] >= s["start"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(both))
        ).otherwise(F.concat(acc, F.array(s)))

    return F.transform(
        F.aggregate(F.array_sort(F.concat(*found)), none, merge),
        lambda s: F.struct(s["start"], s["stop"], F.lit(KINDS.index("entropy")).alias("kind")),
    )


def _is_candidate(word: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | word.rlike(pattern)
    few = F.size(F.array_distinct(F.split(word, ""))) < 8
    return word.rlike("[0-9]") & word.rlike("[A-Za-z]") & ~allowed & ~few


def with_secrets(documents: DataFrame, text_col: str = "text", base: str = "base_spans", spans: str = "spans") -> DataFrame:
    """Adds the spans of the fixed patterns and all spans, as sorted arrays of (start, stop, kind).

    Kinds are numbers, places in ``KINDS``. Columns that are named like the two new ones are
    replaced, all others kept.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    long_enough = lambda word: F.length(F.regexp_extract(word, ASSIGN, 2)) >= ASSIGN_LENGTH
    fixed = F.array_sort(
        F.concat(
            _spans(text, ASSIGN, "assign", long_enough),
            _spans(text, ACCESS, "access"),
            _spans(text, HEX, "hex"),
        ),
        _by_start_then_kind,
    )
    candidates = F.when(
        text.rlike(CANDIDATE),
        F.filter(_places(text, CANDIDATE), lambda x: _is_candidate(x["word"])),
    ).otherwise(F.array().cast("array<struct<start:int,word:string>>"))
    own = f"_{uuid.uuid4().hex}"
    found = documents.withColumn(base, fixed).withColumn(own, candidates)
    random = F.flatten(F.transform(own, _entropy_spans))
    new = F.filter(
        random,
        lambda r: ~F.exists(base, lambda b: (b["start"] <= r["start"]) & (r["stop"] <= b["stop"])),
    )
    every = F.when(F.size(own) > 0, F.array_sort(F.concat(base, new), _by_start_then_kind))
    return found.withColumn(spans, every.otherwise(F.col(base))).drop(own)


def _by_start_then_kind(a: Column, b: Column) -> Column:
    key = lambda x: F.struct(x["start"], x["kind"], x["stop"])
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


def listed(spans: Column) -> Column:
    """kind:start:stop of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
