"""Property tests: Spark expressions against small pure-Python references."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratalake.functions import clean_code, clean_label
from stratalake.operators import repair_coordinates

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

# Java's "\s" (without UNICODE_CHARACTER_CLASS) is exactly these six characters.
_SPECIAL = re.compile(r"[^a-zA-Z0-9 \t\n\x0b\f\r]")


def py_clean_label(s):
    if s is None:
        return "unknown"
    t = _SPECIAL.sub("", s).lower()
    return "".join(w[:1].upper() + w[1:] for w in t.split(" "))


def py_clean_code(s):
    return "unknown" if s is None else s.replace(" ", "")


labels = st.lists(
    st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("aZ9 -_'#\t\nçÉß日 ")), max_size=12), st.text(max_size=8)),
    min_size=1, max_size=40,
)


@SETTINGS
@given(labels)
def test_label_cleaners_match_reference(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: (r.a, r.b) for r in df.select("i", clean_label("s").alias("a"), clean_code("s").alias("b")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (py_clean_label(v), py_clean_code(v)), repr(v)


# --- coordinates, with Spark's ordering: NaN is above every number and equals itself
def _lt(a, b):
    if a is None or b is None:
        return None
    if math.isnan(a):
        return False
    if math.isnan(b):
        return True
    return a < b


def _gt(a, b):
    return _lt(b, a)


def _not(x):
    return None if x is None else not x


def _and(a, b):
    if a is False or b is False:
        return False
    if a is None or b is None:
        return None
    return True


def _or(a, b):
    if a is True or b is True:
        return True
    if a is None or b is None:
        return None
    return False


def _between(x, lo, hi):
    return _and(_not(_lt(x, lo)), _not(_gt(x, hi)))


def _outside(x, b):
    return _or(_lt(x, -b), _gt(x, b))


def _inverted(la, lo):
    return _or(_and(_outside(la, 90), _between(lo, -90, 90)), _and(_outside(lo, 180), _between(la, -180, 180)))


def _keep(x, b):
    return x if _between(x, -b, b) is True else None


def py_repair(la, lo, mode):
    sw = _inverted(la, lo) is True
    new_la = _keep(lo if sw else la, 90)
    if mode == "atomic":
        return new_la, _keep(la if sw else lo, 180)
    sw2 = _inverted(new_la, lo) is True
    return new_la, _keep(new_la if sw2 else lo, 180)


coord = st.one_of(
    st.none(), st.just(float("nan")), st.just(float("inf")), st.just(-float("inf")),
    st.sampled_from([90.0, -90.0, 180.0, -180.0, 0.0]),
    st.floats(min_value=-400, max_value=400, allow_nan=False),
)


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(b):
        return math.isnan(a)
    return a == b


@SETTINGS
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=60))
def test_repair_matches_reference(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                               "i int, latitude double, longitude double")
    for mode in ("atomic", "sequential"):
        got = {r.i: (r.latitude, r.longitude) for r in repair_coordinates(df, mode=mode).collect()}
        for i, (a, b) in enumerate(pairs):
            want = py_repair(a, b, mode)
            assert _same(got[i][0], want[0]) and _same(got[i][1], want[1]), (a, b, mode, got[i], want)
