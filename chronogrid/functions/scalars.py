"""Time-axis, pitch and parsing functions on columns.

Nulls give nulls throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Names of the pitch classes from C, and concert pitch.
NOTE_NAMES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")
A4_HZ, A4_MIDI = 440.0, 69


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_even(x) -> Column:
    """Nearest whole number, halves to the even one (SQL's round takes them up)."""
    return F.rint(_c(x)).cast("long")


def micros(ts) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    t = _c(ts).cast("timestamp_ntz")
    day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000
    return day + F.hour(t).cast("long") * 3_600_000_000 + F.minute(t).cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")


def seconds_to_frame(seconds, hop_seconds: float) -> Column:
    return half_even(_c(seconds) / F.lit(hop_seconds))


def ms_to_samples(ms, sample_rate: int) -> Column:
    return half_even(_c(ms) / 1000 * sample_rate)


def frame_centre(frame, hop_size: int) -> Column:
    """Sample at the middle of a frame."""
    return (_c(frame) + 0.5) * hop_size


def log2(x) -> Column:
    """Base-2 logarithm as floating point has it: -inf of 0, NaN below 0 (Spark's own gives null for both)."""
    return _logarithm(F.log2, x)


def _logarithm(of, x) -> Column:
    x = _c(x)
    return F.when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan"))).otherwise(of(x))


def midi_to_hz(midi) -> Column:
    return A4_HZ * F.pow(F.lit(2.0), (_c(midi) - A4_MIDI) / 12.0)


def hz_to_midi(hz) -> Column:
    return A4_MIDI + 12.0 * log2(_c(hz) / A4_HZ)


def cents(a, b) -> Column:
    """Interval from b up to a, -inf where a is 0; null where b is 0."""
    return 1200.0 * log2(_c(a) / F.nullif(_c(b), F.lit(0.0)))


def sounding_cents(a, b) -> Column:
    """Interval from b up to a; null unless both are positive."""
    return F.when((_c(a) > 0) & (_c(b) > 0), cents(a, b))


def tuning_scale(offset_cents) -> Column:
    return F.pow(F.lit(2.0), _c(offset_cents) / 1200.0)


def note_name(midi) -> Column:
    """Name with octave of the nearest semitone, C4 = 60."""
    m = half_even(midi)
    return F.concat(F.element_at(F.array(*map(F.lit, NOTE_NAMES)), (F.pmod(m, F.lit(12)) + 1).cast("int")), (F.floor(m / 12) - 1).cast("string"))


def string_index(number) -> Column:
    """0 for the lowest of six strings from their customary numbers, 1 for the highest."""
    return 6 - _c(number)


def position(measure, offset, length) -> Column:
    """Measure number with the offset as a fraction of the measure."""
    return _c(measure) + _c(offset) / F.greatest(F.lit(1), _c(length))


def decibels(energy) -> Column:
    return 10.0 * _logarithm(F.log10, _c(energy) + 1e-12)


def clip(x, low, high) -> Column:
    return F.least(F.greatest(_c(x), F.lit(low)), F.lit(high))


def lenient_int(text) -> Column:
    """Whole part of a number in a text, 0 where there is none."""
    value = F.expr(text) if isinstance(text, str) else text
    return F.coalesce(value.try_cast("double").cast("long"), F.lit(0).cast("long"))


def overlaps(start, end, other_start, other_end) -> Column:
    """Whether two half-open intervals meet."""
    return (_c(start) < _c(other_end)) & (_c(other_start) < _c(end))


def sharp_to_word(name) -> Column:
    """``A#`` as ``Asharp`` in file names."""
    return F.regexp_replace(_c(name), "([A-G])#", "$1sharp")


def blank_to_null(text) -> Column:
    return F.nullif(F.trim(_c(text)), F.lit(""))
