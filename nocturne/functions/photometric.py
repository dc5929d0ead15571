"""Magnitudes, errors, calibration terms and source profiles as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POGSON = 1.0857
#: Prior extinction in magnitudes per airmass by filter.
EXTINCTION = {"U": 0.55, "B": 0.25, "V": 0.15, "R": 0.09, "I": 0.06, "u": 0.55, "g": 0.20, "r": 0.10, "i": 0.05, "z": 0.05}


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive, else 0."""
    return F.when(b > 0, F.try_divide(a, b)).otherwise(F.lit(0.0))


def instrumental_mag(flux: Column, exptime: Column) -> Column:
    return F.when(flux > 0, F.lit(-2.5) * F.log10(flux / F.greatest(exptime, F.lit(1e-3))))


def instrumental_mag_err(snr: Column) -> Column:
    return F.when(snr > 0, F.lit(POGSON) / snr)


def lightcurve_err(err: Column, snr: Column) -> Column:
    """The error where it is known and positive, else a floor from the signal-to-noise ratio."""
    fallback = F.greatest(F.lit(POGSON) / F.greatest(F.coalesce(snr, F.lit(0.0)), F.lit(1e-3)), F.lit(0.005))
    return F.when(err > 0, err).otherwise(fallback)


def calibrated_mag(mag_inst: Column, zeropoint: Column) -> Column:
    return mag_inst + zeropoint


def calibrated_mag_err(err: Column, scatter: Column) -> Column:
    return F.sqrt(err * err + scatter * scatter)


def extinction_prior(filt: Column) -> Column:
    table = F.create_map(*[x for k, v in EXTINCTION.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(table, filt), F.lit(0.0))


def electrons(mag: Column, exptime: Column, zeropoint: Column) -> Column:
    return exptime * F.pow(F.lit(10.0), F.lit(-0.4) * (mag - zeropoint))


def moffat(r: Column, fwhm: Column, beta: float) -> Column:
    """Normalised surface brightness of a Moffat profile at radius r."""
    alpha = fwhm / (2.0 * (2.0 ** (1.0 / beta) - 1.0) ** 0.5)
    return (beta - 1.0) / (F.lit(3.141592653589793) * alpha * alpha) * F.pow(1.0 + F.pow(r / alpha, F.lit(2.0)), F.lit(-beta))
