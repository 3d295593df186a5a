"""The stated chance that a pair at the limit shares no band."""

from fractions import Fraction
from math import comb
from pathlib import Path

from tillscope.llm import near_dedup, setsketch


def test_stated_miss_is_that_of_two_regroupings():
    """Both regroupings are of the same registers: independent only given how many are equal."""
    n, width = setsketch.REGISTERS, near_dedup.BAND_WIDTH
    bands, p = n // width, Fraction(near_dedup.PERCENT, 100)
    miss = Fraction(0)
    for equal in range(n + 1):
        ways = sum(
            (-1) ** j * comb(bands, j) * comb(n - width * j, equal - width * j)
            for j in range(min(bands, equal // width) + 1)
        )
        none = Fraction(ways, comb(n, equal))
        miss += comb(n, equal) * p**equal * (1 - p) ** (n - equal) * none**near_dedup.BAND_ORDERS
    stated = f"{float(miss):.1e}".replace("e-0", "e-")
    assert f"probability {stated}" in (Path(__file__).parents[2] / "README.md").read_text()
