"""Scores as performed notes: MusicXML, and tablature in a neutral JSON form.

The JSON form is one object: ``tempo``, ``tuning`` {string: open pitch}, ``capo``, and
``measures``, each with number, length, open (a repeat begins), close (extra passes),
alternative, and beats: tick (in the measure), tempo (a change, or null), notes: string,
fret, type.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame

from .files import parsed

#: Semitones of the steps, number of strings, note types that do not sound anew.
STEPS, STRINGS, SILENT = {"C": 0, "D": 2, "E": 4, "F": 5, "G": 7, "A": 9, "B": 11}, 6, ("tie",)
NOTE = "idx long, measure int, offset int, measure_len int, pitch int, string int, fret int"


def whole(text: str | None) -> int:
    """Whole part of a number in a text; 0 for none."""
    return int(float((text or "").strip() or 0))


def pitch_of(step: str | None, octave: str | None, alter: str | None) -> int | None:
    """MIDI number, None where step or octave can't be read; an alteration that can't is none."""
    name, high = (step or "").strip().upper(), (octave or "").strip()
    if name not in STEPS or not high.removeprefix("-").isdigit():
        return None
    try:
        shift = whole(alter)
    except ValueError:
        shift = 0
    return STEPS[name] + 12 * (int(high) + 1) + shift


def performed(bars: list[dict]) -> list[int]:
    """Order in which bars are played.

    A bar: ``forward`` (a repeat begins), ``times`` (passes of a repeat that ends here,
    or None), ``endings`` (numbers of a volta that begins here), ``stop`` (a volta ends
    here). Orders that run away are dropped for the written one.
    """
    n, order, at, section, turn = len(bars), [], 0, 0, 1
    while at < n and len(order) <= 20 * n + 100:
        bar = bars[at]
        if bar["forward"] and at != section:
            section, turn = at, 1
        if bar["endings"] and turn not in bar["endings"]:
            at = next((k + 1 for k in range(at, n) if bars[k]["stop"]), n)
            continue
        order.append(at)
        again = bar["times"] is not None and turn < bar["times"]
        turn = turn + 1 if again else 1 if bar["times"] is not None else turn
        at = section if again else at + 1
    return order if at >= n and len(order) <= 20 * n + 100 else list(range(n))


def _bar(measure: ET.Element) -> dict:
    out = {"forward": False, "times": None, "endings": set(), "stop": False}
    for line in measure.iter("barline"):
        repeat, ending = line.find("repeat"), line.find("ending")
        if repeat is not None and repeat.get("direction") == "forward" and line.get("location") != "right":
            out["forward"] = True
        if repeat is not None and repeat.get("direction") == "backward" and out["times"] is None:
            out["times"] = int(repeat.get("times", 2))
        if ending is not None and ending.get("type") == "start":
            out["endings"] |= {int(x) for x in map(str.strip, (ending.get("number") or "").split(",")) if x.isdigit()}
        if ending is not None and ending.get("type") in ("stop", "discontinue"):
            out["stop"] = True
    return out


def bar_notes(measure: ET.Element) -> list[tuple[int, int, int, int]]:
    """(offset, pitch, string, fret) of a measure, by its cursor: chords stay at the note before, grace notes take no time, rests do."""
    notes, cursor, last = [], 0, 0
    for item in measure:
        if item.tag not in ("note", "backup", "forward"):
            continue
        length = whole(item.findtext("duration"))
        if item.tag != "note":
            cursor += length if item.tag == "forward" else -length
            continue
        chord, timeless = item.find("chord") is not None, item.find("grace") is not None
        pitched = item.find("pitch")
        if item.find("rest") is None and pitched is not None:
            last = last if chord else cursor
            number = pitch_of(*(pitched.findtext(k) for k in ("step", "octave", "alter")))
            string, fret = (item.findtext(f".//technical/{k}") for k in ("string", "fret"))
            if None not in (number, string, fret):
                notes.append((max(0, last), number, int(string), int(fret)))
        if not chord and not timeless:
            cursor += length
    return notes


def _part(content: bytes) -> ET.Element:
    try:
        root = ET.fromstring(content)
    except ET.ParseError as e:
        raise ValueError(f"not XML: {e}") from e
    for part in root.findall("part"):
        if part.find(".//technical/string") is not None:
            return part
    raise ValueError("no part has string annotations")


def musicxml_notes(content: bytes) -> list[tuple]:
    """(place, measure as performed, offset, measure length, pitch, string, fret) of the first part with strings, repeats played."""
    measures = _part(content).findall("measure")
    divisions, beats, unit, lengths = 1, 4, 4, []
    for m in measures:
        for a in m.findall("attributes"):
            divisions = int(a.findtext("divisions") or divisions)
            time = a.find("time")
            if time is not None:
                beats, unit = int(time.findtext("beats")), int(time.findtext("beat-type"))
        lengths.append(int(divisions * beats * 4 / unit))
    rows = []
    for place, k in enumerate(performed([_bar(m) for m in measures])):
        rows += [(place, offset, lengths[k], *rest) for offset, *rest in bar_notes(measures[k])]
    return [(k, *r) for k, r in enumerate(rows)]


def musicxml_measures(content: bytes) -> list[tuple[int, int]]:
    """[(written, performed)] measure counts."""
    measures = _part(content).findall("measure")
    return [(len(measures), len(performed([_bar(m) for m in measures])))]


def musicxml_tuning(content: bytes) -> list[tuple[int, int]]:
    """(string, open pitch) as declared. Lines count from the lowest string, strings from the highest."""
    try:
        root = ET.fromstring(content)
    except ET.ParseError as e:
        raise ValueError(f"not XML: {e}") from e
    out = {}
    for line in root.iterfind(".//staff-details/staff-tuning"):
        step, octave = line.findtext("tuning-step"), line.findtext("tuning-octave")
        if line.get("line") and step and octave:
            if step not in STEPS:
                raise ValueError(f"tuning step {step!r}")
            out[STRINGS + 1 - int(line.get("line"))] = 12 * (int(octave) + 1) + STEPS[step] + whole(line.findtext("tuning-alter"))
    return sorted(out.items())


def repeated(measures: list[dict]) -> list[int]:
    """Order in which tablature measures are played: ``close`` counts extra passes. ValueError at alternate endings."""
    order, left, at, section = [], {}, 0, 0
    while at < len(measures):
        m = measures[at]
        if m.get("alternative"):
            raise ValueError(f"measure {m.get('number', at + 1)} has an alternate ending")
        section = at if m.get("open") else section
        order.append(at)
        left.setdefault(at, m.get("close") or 0)
        if left[at] > 0:
            left[at] -= 1
            at = section
        else:
            at += 1
    return order


def tablature(content: bytes) -> dict:
    """notes (tick, measure, offset, measure_len, pitch, string, fret) in playing order, tempos (tick, bpm), tuning."""
    try:
        song = json.loads(content)
    except ValueError as e:
        raise ValueError(f"not JSON: {e}") from e
    tuning = {int(s): p + song.get("capo", 0) for s, p in song["tuning"].items()}
    notes, tempos, cursor = [], [(0, song["tempo"])], 0
    for k in repeated(song["measures"]):
        m = song["measures"][k]
        for beat in m["beats"]:
            tick = cursor + beat["tick"]
            if beat.get("tempo") is not None:
                tempos.append((tick, beat["tempo"]))
            for x in beat["notes"]:
                if x.get("type") not in SILENT and x["string"] in tuning:
                    notes.append((tick, m["number"], beat["tick"], max(1, m["length"]), tuning[x["string"]] + x["fret"], x["string"], x["fret"]))
        cursor += m["length"]
    return {"notes": sorted(notes, key=lambda r: (r[0], r[4])), "tempos": sorted(tempos), "tuning": tuning}


def read_musicxml(files: DataFrame) -> DataFrame:
    return parsed(files, musicxml_notes, NOTE)


def read_tunings(files: DataFrame) -> DataFrame:
    return parsed(files, musicxml_tuning, "string int, open int")


def read_measure_counts(files: DataFrame) -> DataFrame:
    return parsed(files, musicxml_measures, "written int, performed int")


def read_tablature(files: DataFrame) -> DataFrame:
    return parsed(files, lambda c: [(k, *r) for k, r in enumerate(tablature(c)["notes"])], "idx long, tick long, measure int, offset int, measure_len int, pitch int, string int, fret int")


def read_tempos(files: DataFrame) -> DataFrame:
    return parsed(files, lambda c: tablature(c)["tempos"], "tick long, bpm double")
