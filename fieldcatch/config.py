"""Run parameters and fixed domain values."""

from __future__ import annotations

import os
from dataclasses import dataclass

# Codes with a meaning of their own.
NO_FISH = "NFC"
UNKNOWN_SPECIES_FILL = "FMS"
MONITORING, SUPPLEMENTAL, NON_NATIVE = 96, 97, 120
RIVER_CODE = "COR"
ELECTROFISHING_GEAR = "EL"
HOOP_GEARS = ("MHB", "HB")
TURBIDITY_CODE = "L"

# Total length from fork length, TL = intercept + slope * FL.
LENGTH_COEFFICIENTS = {
    "BNT": (8.211, 1.024),
    "RBT": (1.9557129, 1.0643074),
    "CRP": (6.266, 1.100),
}

# Relative condition of RBT, Kn = W / 10 ^ (intercept + slope * log10(TL)).
CONDITION_SPECIES = "RBT"
CONDITION_INTERCEPT = -4.6023
CONDITION_SLOPE = 2.8193

# Size classes, each bin open on the left and closed on the right.
SIZE_CLASSES = {
    "BNT": ((0, 200, "<200"), (200, 350, "200-350"), (350, None, ">350")),
    "RBT": ((0, 151, "<152"), (151, 305, "152-305"), (305, 405, "306-405"), (405, None, ">405")),
}

# River reaches by start mile, open on the left and closed on the right.
REACHES = (
    (-15.31, -10.8, "(-15.3,-10.8]"),
    (-10.8, -4.0, "(-10.8,-4]"),
    (-4.0, -0.3, "(-4,-0.3]"),
)

# Recapture codes. P = tag recaptured, F = fin clip, B = both; Y / N = answer.
TAG_RECAP = {"Y": ("BY", "PY"), "N": ("BN", "FY")}
CLIP_RECAP = {"Y": ("BY", "FY"), "N": ("BN", "PY")}

# Centre point of the slough, used where no mile or side was recorded.
SLOUGH_MARK = "SLOUGH"
SLOUGH_MILE = -12.15
SLOUGH_SIDE = "L"
SLOUGH_SITES = ("SLOUGH 1A", "SLOUGH 1B", "SLOUGH 1C")

# Quality thresholds.
MILE_TOLERANCE = 0.20
LENGTH_GAP_LIMIT = 40
MAX_SET_HOURS = 24
NORMAL_975 = 1.959963984540054

# Plausibility rules per species (largest total length in mm, may it carry a tag).
PLAUSIBLE = (("FHM", 70, False),)

# Names shown on the length histogram.
SPECIES_NAMES = {"RBT": "Rainbow Trout", "BNT": "Brown Trout"}


@dataclass(frozen=True)
class TripConfig:
    """What the scripts' hand-edited header held: the trip, folders and key offsets."""

    trip_id: str
    input_dir: str = "."
    output_dir: str = "."
    samples_before: int = 0
    specimens_before: int = 0

    @property
    def year(self) -> int:
        return int(self.trip_id[2:6])

    def input_path(self, name: str) -> str:
        """`<input_dir>/<trip_id><name>`; a name with a glob reads many files at once."""
        return os.path.join(self.input_dir, f"{self.trip_id}{name}")

    def output_path(self, name: str) -> str:
        return os.path.join(self.output_dir, f"{self.trip_id}{name}")
