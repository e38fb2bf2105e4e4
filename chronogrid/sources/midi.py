"""Standard MIDI files as notes in seconds."""

from __future__ import annotations

import struct
from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .files import parsed

#: String of each track after the first, tempo where none is given (µs a beat), latency taken off.
TRACK_STRINGS, DEFAULT_TEMPO, LATENCY_MS = (5, 4, 3, 2, 1, 0), 500_000, 23.0
_DATA_BYTES = {0x80: 2, 0x90: 2, 0xA0: 2, 0xB0: 2, 0xC0: 1, 0xD0: 1, 0xE0: 2}


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = 0
    while True:
        byte = data[at]
        value, at = value << 7 | byte & 0x7F, at + 1
        if byte < 0x80:
            return value, at


def _events(data: bytes) -> Iterator[tuple[int, str, int, int]]:
    """(tick, kind, a, b) of a track chunk: on (pitch, velocity), off (pitch, 0), tempo (µs, 0)."""
    at = tick = status = 0
    while at < len(data):
        delta, at = _number(data, at)
        tick += delta
        if data[at] >= 0x80:
            first, at = data[at], at + 1
        else:
            first = status
        if first == 0xFF:
            kind = data[at]
            size, at = _number(data, at + 1)
            if kind == 0x51:
                yield tick, "tempo", int.from_bytes(data[at : at + size], "big"), 0
            at += size
        elif first in (0xF0, 0xF7):
            size, at = _number(data, at)
            at += size
        elif first >= 0x80 and first & 0xF0 in _DATA_BYTES:
            status, kind = first, first & 0xF0
            body, at = data[at : at + _DATA_BYTES[kind]], at + _DATA_BYTES[kind]
            if kind in (0x80, 0x90):
                on = kind == 0x90 and body[1] > 0
                yield tick, "on" if on else "off", body[0], body[1] if on else 0
        else:
            raise ValueError(f"status byte {first:#x}")


def tracks(content: bytes) -> tuple[int, list[list[tuple[int, str, int, int]]]]:
    """(ticks a beat, events of each track); ValueError if it is no MIDI file."""
    try:
        if content[:4] != b"MThd":
            raise ValueError("no MIDI header")
        size, _, count, division = struct.unpack(">IHHh", content[4:14])
        if division <= 0:
            raise ValueError("time code divisions are not supported")
        at, out = 8 + size, []
        while at + 8 <= len(content) and len(out) < count:
            name, length = content[at : at + 4], struct.unpack(">I", content[at + 4 : at + 8])[0]
            if at + 8 + length > len(content):
                raise ValueError("the file ends inside a track")
            if name == b"MTrk":
                out.append(list(_events(content[at + 8 : at + 8 + length])))
            at += 8 + length
        return division, out
    except (IndexError, struct.error) as e:
        raise ValueError(f"not a MIDI file: {e}") from e


class TempoMap:
    """Seconds of ticks under all tempo changes of a file."""

    def __init__(self, division: int, all_tracks):
        changes = sorted((t, a) for track in all_tracks for t, kind, a, _ in track if kind == "tempo")
        if not changes or changes[0][0]:
            changes.insert(0, (0, DEFAULT_TEMPO))
        self.division, self.sections, second = division, [], 0.0
        for k, (tick, tempo) in enumerate(changes):
            if k:
                second += (tick - changes[k - 1][0]) * changes[k - 1][1] * 1e-6 / division
            self.sections.append((tick, second, tempo * 1e-6 / division))

    def seconds(self, tick: int) -> float:
        start, second, rate = next(s for s in reversed(self.sections) if s[0] <= max(tick, 0))
        return second + (tick - start) * rate


def merged_notes(content: bytes) -> list[tuple[int, float, float, int]]:
    """(place, onset, offset, pitch) of all tracks together: of notes of one pitch the first on ends first. Notes without an end are left out."""
    division, all_tracks = tracks(content)
    clock = TempoMap(division, all_tracks)
    sounding: dict[int, deque] = {}
    notes = []
    for tick, kind, pitch, _ in sorted((e for t in all_tracks for e in t if e[1] != "tempo"), key=lambda e: e[0]):
        if kind == "on":
            sounding.setdefault(pitch, deque()).append(clock.seconds(tick))
        elif sounding.get(pitch):
            notes.append((sounding[pitch].popleft(), clock.seconds(tick), pitch))
    return [(k, *n) for k, n in enumerate(sorted(notes))]


def string_notes(content: bytes, latency_ms: float = LATENCY_MS) -> list[tuple[int, int, int, float, float]]:
    """(place, string, pitch, start, end) of files with a track for each string after a first one: the latest on of a pitch is the one that ends. The latency comes off both ends; what then ends at or before 0 is left out."""
    division, all_tracks = tracks(content)
    clock, notes = TempoMap(division, all_tracks), []
    for string, track in zip(TRACK_STRINGS, all_tracks[1:], strict=False):
        started: dict[int, int] = {}
        for tick, kind, pitch, _ in track:
            if kind == "on":
                started[pitch] = tick
            elif kind == "off" and pitch in started:
                start, end = (clock.seconds(t) - latency_ms / 1000 for t in (started.pop(pitch), tick))
                if end > max(start, 0):
                    notes.append((string, pitch, max(start, 0.0), end))
    notes.sort(key=lambda n: (n[2], n[0]))
    return [(k, *n) for k, n in enumerate(notes)]


def read_merged(files: DataFrame) -> DataFrame:
    return parsed(files, merged_notes, "idx long, onset double, offset double, pitch int")


def read_strings(files: DataFrame, latency_ms: float = LATENCY_MS) -> DataFrame:
    return parsed(files, lambda c: string_notes(c, latency_ms), "idx long, string int, pitch int, start double, end double")
