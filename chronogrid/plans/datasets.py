"""Kinds of data sets: how their files are paired, which recipe reads them, how they are split."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..sources.tables import NAMINGS, Naming


@dataclass(frozen=True)
class Kind:
    """A kind of data set. ``namings``: its audio sources; ``splits``: the splits that make sense for it; ``exclude``: takes left out unless asked for."""

    recipe: str
    about: str
    splits: tuple[str, ...]
    namings: dict[str, Naming] = field(default_factory=dict)
    exclude: tuple[str, ...] = ()

    def naming(self, source: str) -> Naming:
        if source not in self.namings:
            raise ValueError(f"source is one of {sorted(self.namings)}, not {source!r}")
        return self.namings[source]


#: Takes whose notes do not say the sounding pitch.
WRONG_PITCH = ("Bendings", "Vibrato", "PinchHarmonics", "Harmonics")

KINDS = {
    "contours": Kind("contour_frames", "pitch contours by string (JAMS)", ("player", "folds", "random", "mirror"), {k: NAMINGS[k] for k in ("mic", "mix")}),
    "scores": Kind("synced_score_frames", "performed MIDI with a score and sync points", ("grouped", "random")),
    "tablature": Kind("tablature_frames", "MIDI with tablature, gated by alignment", ("random", "grouped")),
    "strings": Kind("string_midi_frames", "MIDI with a track for each string", ("held-out",), {k: NAMINGS[k] for k in ("directinput", "micamp", "ego", "exo")}, WRONG_PITCH),
}


def kind(name: str) -> Kind:
    if name not in KINDS:
        raise ValueError(f"kind is one of {sorted(KINDS)}, not {name!r}")
    return KINDS[name]
