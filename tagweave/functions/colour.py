"""Colours as columns: hue, saturation and value; linear and gamma-coded channels; hexadecimal numbers. Channels are in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagweave.functions.sampling import normal


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """ARRAY of red, green and blue; hues go round."""
    turn = F.pmod(h.cast("double"), F.lit(1.0)) * 6

    def channel(offset: float) -> Column:  # how far the hue is from the channel's dark side
        at = F.pmod(turn + offset, F.lit(6.0))
        return v - v * s * F.greatest(F.lit(0.0), F.least(at, 4 - at, F.lit(1.0)))

    return F.array(channel(5.0), channel(3.0), channel(1.0))


def rgb_to_hsv(r: Column, g: Column, b: Column) -> Column:
    """ARRAY of hue, saturation and value; greys have hue 0, black saturation 0."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = top - low
    part = lambda x, y, at: F.try_divide(x - y, span) / 6 + at
    hue = F.when(top == r, part(g, b, 0.0)).when(top == g, part(b, r, 1 / 3)).otherwise(part(r, g, 2 / 3))
    return F.array(F.when(span == 0, F.lit(0.0)).otherwise(F.pmod(hue, F.lit(1.0))), F.when(top == 0, F.lit(0.0)).otherwise(F.try_divide(span, top)), top.cast("double"))


def srgb_to_linear(c: Column) -> Column:
    """A gamma-coded channel as light; below 0 it is 0."""
    return F.when(c < 0, F.lit(0.0)).when(c < 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def hex_to_rgba(text: Column, alpha: float = 1.0) -> Column:
    """ARRAY of linear red, green, blue, and alpha from ``#RRGGBB`` (with or without the mark)."""
    digits = F.regexp_replace(text, "^(#|0x)", "")
    channel = lambda k: srgb_to_linear(F.conv(F.substring(digits, k, 2), 16, 10).cast("double") / 255)
    return F.array(channel(1), channel(3), channel(5), F.lit(float(alpha)))


def nearby_colour(r: Column, g: Column, b: Column, deviation: float, seed: int) -> Column:
    """The colour with its hue moved at random, alike for all colours of one hue (to a thousandth) and seed."""
    hsv = rgb_to_hsv(r, g, b)
    shift = normal(seed, F.floor(hsv[0] * 1000)) * deviation
    return hsv_to_rgb(hsv[0] + shift, hsv[1], hsv[2])
