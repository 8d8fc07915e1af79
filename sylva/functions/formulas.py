"""Scalar carbon formulas (H1, H2, H4, H5) as column expressions.

Coefficients are columns (joined from parameter tables) or Python numbers; no
coefficient values are defined here except the documented reduction factor b."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the model documentation:
#   stand-modifier reduction factor b = 6.93 (decomposition halves at 10% of max biomass)
#   slow mixing rate above- to below-ground slow pool = 0.006 per year
STAND_MOD_B = 6.93
SLOW_MIXING_RATE = 0.006


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def temp_modifier(mat, ref_temp, q10) -> Column:
    """H1: exp((MAT - RefTemp) * ln(Q10) * 0.1)."""
    return F.exp((_c(mat) - _c(ref_temp)) * F.log(_c(q10)) * F.lit(0.1))


def stand_modifier(tot_bio, max_bio, max_r=1.0, b: float = STAND_MOD_B) -> Column:
    """H2: 1 + (max_r - 1) * exp(-b * TotBio / MaxBio). MaxBio = 0 gives NULL instead of
    an ANSI division error."""
    ratio = _c(tot_bio) / F.nullif(_c(max_bio), F.lit(0.0))
    return F.lit(1.0) + (_c(max_r) - F.lit(1.0)) * F.exp(F.lit(-b) * ratio)


def decay_rate(base_rate, temp_mod, stand_mod) -> Column:
    """H3 scalar part: a_k = D_k * TempMod * StandMod."""
    return _c(base_rate) * _c(temp_mod) * _c(stand_mod)


def root_biomass(merch, foliage, other, sw_hw, hw_a, hw_b, sw_a) -> tuple[Column, Column]:
    """H4: (T_hw, T_sw). The wood type a row is not gets 0, not NULL, so H5's sum works."""
    agb2 = (_c(merch) + _c(foliage) + _c(other)) * F.lit(2.0)
    t_hw = F.when(_c(sw_hw) == 1, _c(hw_a) * F.pow(agb2, _c(hw_b))).otherwise(F.lit(0.0))
    t_sw = F.when(_c(sw_hw) == 0, _c(sw_a) * agb2).otherwise(F.lit(0.0))
    return t_hw, t_sw


def fine_root_share(t_hw, t_sw, frp_a, frp_b, frp_c) -> Column:
    """H5: P_fine = frp_a + frp_b * exp((-1/frp_c) * (T_hw + T_sw))."""
    return _c(frp_a) + _c(frp_b) * F.exp((F.lit(-1.0) / _c(frp_c)) * (_c(t_hw) + _c(t_sw)))

