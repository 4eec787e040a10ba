"""Gas solubility and seawater density as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hamme & Emerson (2004), Deep-Sea Research I 51, Table 4 (umol/kg).
SOLUBILITY = {
    "Ar": ((2.79150, 3.17609, 4.13116, 4.90379), (-6.96233e-3, -7.66670e-3, -1.16888e-2)),
    "N2": ((6.42931, 2.92704, 4.32531, 4.69149), (-7.44129e-3, -8.02566e-3, -1.46775e-2)),
}
# UNESCO EOS-80 at one atmosphere (Millero & Poisson 1981).
EOS80_WATER = (999.842594, 6.793952e-2, -9.095290e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9)
EOS80_S = (8.24493e-1, -4.0899e-3, 7.6438e-5, -8.2467e-7, 5.3875e-9)
EOS80_S15 = (-5.72466e-3, 1.0227e-4, -1.6546e-6)
EOS80_S2 = 4.8314e-4


def polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    """Horner evaluation, lowest power first."""
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def gas_solubility(gas: str, temp_degc: Column, sal_psu: Column) -> Column:
    """Ar or N2 in equilibrium with moist air at 1 atm, umol/kg."""
    a, b = SOLUBILITY[gas]
    scaled = F.ln((F.lit(298.15) - temp_degc) / (F.lit(273.15) + temp_degc))
    return F.exp(polynomial(scaled, a) + sal_psu * polynomial(scaled, b))


def seawater_density(temp_degc: Column, sal_psu: Column) -> Column:
    """Density in kg/L at one atmosphere."""
    s = sal_psu
    return (
        polynomial(temp_degc, EOS80_WATER)
        + polynomial(temp_degc, EOS80_S) * s
        + polynomial(temp_degc, EOS80_S15) * F.pow(s, 1.5)
        + F.lit(EOS80_S2) * s * s
    ) / 1000


def n2_ar_sensitivity(raw_ratio: Column, temp_degc: Column, sal_psu: Column) -> Column:
    """Mass-28 to mass-40 sensitivity ratio from an air-equilibrated standard."""
    return raw_ratio / (gas_solubility("N2", temp_degc, sal_psu) / gas_solubility("Ar", temp_degc, sal_psu))
