"""Property tests: operators against a plain-Python brute force on random
small frames (NULL keys, ties and one hot key are all likely)."""

from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyframe.operators import mix_within_top, share_of_total, top_k_per_group

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=5))
pairs = st.lists(st.tuples(st.integers(min_value=0, max_value=3), st.integers(min_value=0, max_value=6)),
                 min_size=1, max_size=60)


def _round2(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(keys, min_size=1, max_size=80))
def test_share_of_total_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k int")
    got = {r.k: r.Percentage_of_Total for r in share_of_total(df, "k").collect()}
    counts = Counter(values)
    want = {k: (_round2(n / len(values) * 100.0) if k is not None else 0.0) for k, n in counts.items()}
    assert got == want


@SETTINGS
@given(pairs, st.integers(min_value=1, max_value=3))
def test_top_k_per_group_brute_force(spark, rows, k):
    df = spark.createDataFrame(rows, "g int, i int")
    got = sorted((r.g, r.i, r.TicketCount, r.Rank) for r in top_k_per_group(df, "g", "i", k).collect())
    want = []
    for g in {g for g, _ in rows}:
        counts = Counter(i for gg, i in rows if gg == g)
        levels = sorted(set(counts.values()), reverse=True)
        for i, n in counts.items():
            rank = levels.index(n) + 1
            if rank <= k:
                want.append((g, i, n, rank))
    assert got == sorted(want)


@SETTINGS
@given(pairs, st.integers(min_value=1, max_value=3))
def test_mix_within_top_brute_force(spark, rows, k):
    df = spark.createDataFrame(rows, "g int, i int")
    got = sorted(
        (r.i, r.g, r.ticket_count, r.perc_ticket_count) for r in mix_within_top(df, "g", "i", k).collect()
    )
    totals = Counter(g for g, _ in rows)
    top = sorted(totals, key=lambda g: (-totals[g], g))[:k]
    pair_counts = Counter(rows)
    want = sorted(
        (i, g, n, _round2(n / totals[g] * 100.0)) for (g, i), n in pair_counts.items() if g in top
    )
    assert got == want


@SETTINGS
@given(st.lists(st.decimals(min_value=-10_000, max_value=10_000, places=4, allow_nan=False), min_size=1, max_size=40))
def test_round_half_up_matches_decimal(spark, values):
    from tallyframe.functions import round_half_up

    floats = [float(v) for v in values]
    df = spark.createDataFrame([(x,) for x in floats], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    want = [float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for x in floats]
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-5, max_value=60, allow_nan=False)), min_size=1, max_size=60))
def test_band_labels_every_row_once(spark, values):
    from tallyframe.functions import TIP_BANDS_HALF_OPEN, band

    df = spark.createDataFrame([(v,) for v in values], "tip double")
    labels = [r[0] for r in df.select(band("tip", TIP_BANDS_HALF_OPEN)).collect()]
    assert len(labels) == len(values) and all(lbl is not None for lbl in labels)
    for v, lbl in zip(values, labels):
        if v is None or v < 0:
            assert lbl == "Other amount"
        else:
            lo = min(int(v // 5) * 5, 20)
            assert lbl == (">=20" if lo == 20 else f"[{lo}-{lo + 5})")
