"""Safe casts C1-C5 on hand-written texts (expected values follow SQLite's cast rules)."""

import pytest

from conftest import one_col
from kiln.functions import casts

INPUTS = ["abc", "12abc", " 12 ", "12.7", "", "  ", "1e3", "007", "+5", "-25", "0", "-0", "1,200",
          "99999999999999999999", "12.0", "$12", "-", ".5", "5.", "TBD", None, "12d", "NaN", "\t7"]

STRICT = [None, None, 12, None, None, None, None, None, None, -25, 0, None, None,
          None, None, None, None, None, None, None, None, None, None, None]
LARGEST = 9223372036854775807   # integers beyond 64 bits become the nearest one that fits
POS_INT = [None, 12, 12, 12, None, None, 1, 7, 5, None, None, None, 1,
           LARGEST, 12, None, None, None, 5, None, None, 12, None, 7]
ALPHA_REAL = [None, None, 12.0, 12.7, None, None, None, 7.0, 5.0, -25.0, 0.0, -0.0, 1.0,
              1e20, 12.0, 0.0, 0.0, 0.5, 5.0, None, None, None, None, 7.0]
POS_REAL = [None, 12.0, 12.0, 12.7, None, None, 1000.0, 7.0, 5.0, None, None, None, 1.0,
            1e20, 12.0, None, None, 0.5, 5.0, None, None, 12.0, None, 7.0]
UNGUARDED = [0, 12, 12, 12, 0, 0, 1, 7, 5, -25, 0, 0, 1,
             LARGEST, 12, 0, 0, 0, 5, 0, None, 12, 0, 7]


@pytest.mark.parametrize("fn,expected", [
    (casts.strict_int, STRICT), (casts.positive_int, POS_INT), (casts.alpha_reject_real, ALPHA_REAL),
    (casts.positive_real, POS_REAL), (casts.unguarded_int, UNGUARDED)],
    ids=["C1_strict_int", "C2_positive_int", "C3_alpha_reject_real", "C4_positive_real", "C5_unguarded_int"])
def test_cast_table(spark, fn, expected):
    got = one_col(spark, INPUTS, fn)
    for text, g, e in zip(INPUTS, got, expected):
        assert g == e, f"{fn.__name__}({text!r}) = {g!r}, expected {e!r}"


def test_strict_int_keeps_negatives_and_rejects_trailing_newline(spark):
    assert one_col(spark, ["-7", "7\n", "12 "], casts.strict_int) == [-7, None, 12]


def test_casts_never_fail_under_ansi(spark):
    # ANSI mode is on; junk must come back as NULL / lenient values, never raise
    junk = ["é", "1e999", "--1", "0x1F", "1_000", "  -  "]
    for fn in (casts.strict_int, casts.positive_int, casts.alpha_reject_real, casts.positive_real,
               casts.unguarded_int):
        one_col(spark, junk, fn)


def test_strict_real_variant(spark):
    got = one_col(spark, ["12.5", " 7 ", "1,200", "$12", "1e3", "-3.25", "", None, ".5", "5."], casts.strict_real)
    assert got == [12.5, 7.0, None, None, None, -3.25, None, None, 0.5, 5.0]
