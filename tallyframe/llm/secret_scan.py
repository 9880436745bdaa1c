"""Secret scan: fixed patterns and sliding-window entropy, in SQL functions.

Everything is an expression over one text column: no Python runs on the
executors and no row moves. Positions come from splitting a text at a
pattern: the pieces between the matches and the matches themselves give
every start as a running sum of lengths (in code points).

Patterns (leftmost, not overlapping, per kind): ``assign``, a credential
word with an assigned value of six or more characters; ``access``, an access
key id of twenty or more; ``hex``, a run of 24 or more hexadecimal digits.

Entropy adds spans of kind ``entropy_hex``, ``entropy_base64`` and
``entropy_piece``. Candidate strings are the runs of MIN_CANDIDATE or more
characters of a class that have both a digit and a letter. Any character but
a letter or digit is a border of hex runs. Base64 runs may hold = / _ and -,
which keys have too; their pieces between these (without the = that pad the
end) are candidates of their own, so that a name or an allow-listed word
beside a key hides neither its entropy nor the key. A window of WINDOW
characters slides over a candidate; the counts per character are updated by
the character that enters and the one that leaves, and the sum of
n * log2(n) with them, so that each step costs the same whatever the length.
A candidate is reported if some window's Shannon entropy reaches the limit of
its class and no allow-list pattern matches the candidate.

Defined results: a null or empty text has no spans; repeated rows are
scanned each; other columns are ignored unless ``keep`` names them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORD = r"(?i)password|passwd|secret|token|api_?key"
# A dropped short match leaves no other match in its run, so the minimum may be in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_MIN = 6
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_piece")

WINDOW = 20
MIN_CANDIDATE = 20
# Before a candidate: the name of an integrity digest is part of it, for the allow-list.
DIGEST = r"[sS][hH][aA](?:1|256|384|512)-"
#: class: (candidate pattern, least entropy of a window in bits)
CLASSES = {
    "entropy_hex": (rf"(?<![A-Za-z0-9])(?:{DIGEST})?[0-9a-fA-F]{{20,}}(?![A-Za-z0-9])", 3.0),
    "entropy_base64": (r"[A-Za-z0-9+/_=-]{20,}", 3.9),
    # What a border precedes, or follows with more of the run behind it.
    "entropy_piece": (
        rf"(?<![A-Za-z0-9+]){DIGEST}[A-Za-z0-9+/]+=*"
        r"|(?<=[=/_-])[A-Za-z0-9+]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
        r"|(?<![A-Za-z0-9+])[A-Za-z0-9+]{20,}(?=[=/_-]+[A-Za-z0-9+])",
        3.9,
    ),
}
#: Candidates that are known to be harmless.
ALLOW = (
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|sample|dummy|placeholder|test_?key|x{6}|your_?(?:api|key|token)",
    r"(?i)^sha(?:1|256|384|512)-",  # integrity digests
    r"(?i)abcdefghij|0123456789",  # alphabets
)
# Steps whose spans are appended to one short array before the long one.
CHUNK = 256
# Code of the first character of the candidate alphabet ('+') and its width (to 'z').
FIRST, ALPHABET = 43, 80


def _int(value: int) -> Column:
    return F.lit(value).cast("int")


def _spans(pieces: Column, matches: Column) -> Column:
    """array<struct<s,e>> of the matches: running sums of the lengths, made
    in chunks so that appending never copies the whole array each time."""
    n = F.size(matches)
    empty = F.array().cast("array<struct<s:int,e:int>>")

    def within(k: Column, base: Column) -> Column:
        steps = F.sequence(k * CHUNK, F.least(k * CHUNK + (CHUNK - 1), n - 1))

        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(pieces, i))
            end = start + F.length(F.get(matches, i))
            return F.struct(
                end.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("s"), end.alias("e")))).alias("out")
            )

        return F.aggregate(steps, F.struct(base.alias("at"), empty.alias("out")), step)

    def chunk(state: Column, k: Column) -> Column:
        # The lambda binds the chunk's result, which is then computed once.
        return F.transform(
            F.array(within(k, state["at"])),
            lambda done: F.struct(done["at"].alias("at"), F.concat(state["out"], F.array(done["out"])).alias("out")),
        )[0]

    chunks = F.sequence(_int(0), ((n - 1) / CHUNK).cast("int"))
    start = F.struct(_int(0).alias("at"), F.array().cast("array<array<struct<s:int,e:int>>>").alias("out"))
    return F.flatten(F.aggregate(chunks, start, chunk, lambda s: s["out"]))


def _n_log_n() -> Column:
    """n * log2(n) for n from 0 to WINDOW."""
    return F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)])


def max_window_entropy(candidate: Column) -> Column:
    """The largest Shannon entropy, in bits per character, of any WINDOW
    consecutive characters of a string over the candidate alphabet."""
    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - FIRST)
    table = _n_log_n()

    def step(state: Column, i: Column) -> Column:
        enter = F.get(state["codes"], i)
        leave = F.when(i >= WINDOW, F.get(state["codes"], i - WINDOW)).otherwise(_int(-1))
        gone = F.transform(state["counts"], lambda n, at: n - F.when(at == leave, 1).otherwise(0))
        before = F.when(leave >= 0, F.get(table, F.get(state["counts"], leave)) - F.get(table, F.get(state["counts"], leave) - 1)).otherwise(F.lit(0.0))
        here = F.get(state["counts"], enter) - F.when(leave == enter, 1).otherwise(0)
        total = state["sum"] - before + F.get(table, here + 1) - F.get(table, here)
        return F.struct(
            state["codes"].alias("codes"),
            F.transform(gone, lambda n, at: n + F.when(at == enter, 1).otherwise(0)).alias("counts"),
            total.alias("sum"),
            F.when(i >= WINDOW - 1, F.least(state["low"], total)).otherwise(state["low"]).alias("low"),
        )

    start = F.struct(
        codes.alias("codes"),
        F.array_repeat(_int(0), ALPHABET).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(float("inf")).alias("low"),
    )
    steps = F.sequence(_int(0), F.length(candidate) - 1)
    # Entropy is log2(W) - sum / W: the lowest sum is the highest entropy.
    return F.aggregate(steps, start, step, lambda s: F.lit(math.log2(WINDOW)) - s["low"] / WINDOW)


def _found(text: Column, pattern: str, check: Column, keep=None) -> Column:
    """Spans of a pattern; ``check`` is a cheap test that must hold for any
    match, ``keep`` says by match number which ones stay."""
    spans = _spans(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    if keep is not None:
        spans = F.filter(spans, keep)
    none = F.array().cast("array<struct<s:int,e:int>>")
    return F.when(check, spans).otherwise(none)


def pattern_spans(text: Column) -> dict[str, Column]:
    """Base spans by kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return {
        "assign": _found(
            text, ASSIGN, text.rlike(ASSIGN_WORD) & text.rlike(ASSIGN), lambda _, i: F.length(F.get(values, i)) >= ASSIGN_MIN
        ),
        "access": _found(text, ACCESS, text.contains("AKIA") & text.rlike(ACCESS)),
        "hex": _found(text, HEX, text.rlike(HEX)),
    }


def entropy_spans(text: Column, kind: str, allow: tuple[str, ...] = ALLOW) -> Column:
    """Spans of the candidates of one class whose entropy is high."""
    pattern, least = CLASSES[kind]
    candidates = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def secret(_, i: Column) -> Column:
        candidate = F.get(candidates, i)
        mixed = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
        for harmless in allow:
            mixed = mixed & ~candidate.rlike(harmless)
        return F.when(mixed, max_window_entropy(candidate) >= least).otherwise(F.lit(False))

    # A class run of the least length with a digit in it is rare in prose.
    return _found(text, pattern, text.rlike(pattern), secret)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """id, one array of spans (s, e) per kind, and the columns in ``keep``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(f"`{c}`").alias(f"kept_{c}") for c in keep])
    found = pattern_spans(text) | {k: entropy_spans(text, k, allow) for k in CLASSES}
    return slim.select("id", *[found[k].alias(k) for k in KINDS], *[F.col(f"`kept_{c}`").alias(c) for c in keep])


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the given span columns, by start, then kind."""

    def tagged(rank: int, kind: str) -> Column:
        return F.transform(
            F.col(kind), lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("n"), x["e"].alias("e"), F.lit(kind).alias("k"))
        )

    every = F.array_sort(F.concat(*[tagged(n, k) for n, k in enumerate(kinds)]))
    return F.array_join(F.transform(every, lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ",")
