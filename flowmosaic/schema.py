"""Shapes, schemas and fixed values of the gridded flow data model."""

from __future__ import annotations

from dataclasses import dataclass

# The 17 weather classes, in one-hot order (code = position).
WEATHER_CLASSES = (
    "Sunny", "Cloudy", "Overcast", "Rainy", "Sprinkle", "ModerateRain", "HeavyRain", "Rainstorm",
    "Thunderstorm", "FreezingRain", "Snowy", "LightSnow", "ModerateSnow", "HeavySnow", "Foggy",
    "Sandstorm", "Dusty",
)

# Divisors that bring flow counts and meteorology to unit scale.
FLOW_UNIT = 100.0
METEO_UNIT = 10.0

# Augmentation schedule as (batch, jitter limit in percent).
AUGMENT_SCHEDULE = ((0, 20.0), (1, 10.0), (2, 10.0), (3, 10.0), (4, 10.0))

N_OTHERS = 2 + len(WEATHER_CLASSES)


@dataclass(frozen=True)
class GridSpec:
    """Grid extent and slot length; everything else about a day's shape follows."""

    rows: int = 32
    cols: int = 32
    slot_minutes: int = 30

    def __post_init__(self) -> None:
        if self.rows < 1 or self.cols < 1:
            raise ValueError("a grid needs at least one row and one column")
        if self.slot_minutes < 1 or 1440 % self.slot_minutes:
            raise ValueError("slot_minutes must divide a day evenly")

    @property
    def slots(self) -> int:
        return 1440 // self.slot_minutes

    @property
    def cells(self) -> int:
        return self.rows * self.cols

    @property
    def channels(self) -> int:
        return 2 * self.slots

    @property
    def tensor_size(self) -> int:
        return self.cells * self.channels


# Table schemas as DDL text, which readers take as it is.
FLOW_SCHEMA = "date DATE, slot INT, grid_row INT, grid_col INT, inflow DOUBLE, outflow DOUBLE"
WEATHER_SCHEMA = "date DATE, slot INT, temperature DOUBLE, windspeed DOUBLE, weather_code INT"
RAW_DAYS_SCHEMA = "date DATE, flow ARRAY<DOUBLE>, others ARRAY<DOUBLE>, label INT"
GEN_DAYS_SCHEMA = (
    "source_date DATE, flow ARRAY<DOUBLE>, others ARRAY<DOUBLE>, label INT, limit DOUBLE, batch INT"
)
