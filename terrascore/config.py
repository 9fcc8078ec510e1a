"""Run configuration and the domain constants of the suitability model.

Everything a run can vary lives in :class:`PipelineConfig`; how one raster
source becomes a monthly per-field series lives in :class:`SourceSpec`.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

# --------------------------------------------------------------------------
# Fixed values. These must equal the modelled project's for equal results:
# season months, factor weights, default run period, and the
# threshold seed (feature, period, optimal_min, optimal_max, acceptable_min,
# acceptable_max), given here in the seed's own order.
# --------------------------------------------------------------------------
SEASON_MONTHS: tuple[tuple[str, tuple[int, ...]], ...] = (
    ("germination_early_growth", (11, 12, 1, 2)),
    ("vegetative_growth", (3, 4, 5)),
    ("sugar_accumulation", (6, 7, 8)),
)
OTHER_PERIOD = "other_period"
STATIC_PERIOD = "static"

# total = 0.4 * temperature + 0.3 * rainfall + 0.2 * ndvi + 0.1 * mean(soil scores)
WEIGHTS: tuple[tuple[str, float], ...] = (
    ("temperature", 0.4),
    ("rainfall", 0.3),
    ("ndvi", 0.2),
    ("soil", 0.1),
)

DEFAULT_START = "2020-01-01"
DEFAULT_END = "2024-12-31"

THRESHOLD_SEED: tuple[tuple[str, str, float, float, float, float], ...] = (
    ("ndvi", "germination_early_growth", 0.1, 0.3, 0.05, 0.4),
    ("ndvi", "vegetative_growth", 0.6, 0.8, 0.4, 0.9),
    ("ndvi", "sugar_accumulation", 0.7, 0.9, 0.5, 0.95),
    ("temperature", "germination_early_growth", 10.0, 20.0, 5.0, 25.0),
    ("temperature", "vegetative_growth", 20.0, 30.0, 15.0, 35.0),
    ("temperature", "sugar_accumulation", 15.0, 25.0, 10.0, 30.0),
    ("rainfall", "germination_early_growth", 50.0, 100.0, 30.0, 150.0),
    ("rainfall", "vegetative_growth", 100.0, 200.0, 50.0, 300.0),
    ("rainfall", "sugar_accumulation", 80.0, 150.0, 40.0, 200.0),
    ("soil_ph", "static", 6.0, 7.5, 5.5, 8.0),
    ("soil_cec", "static", 15.0, 30.0, 10.0, 40.0),
    ("clay", "static", 20.0, 40.0, 15.0, 50.0),
    ("silt", "static", 30.0, 50.0, 25.0, 60.0),
    ("sand", "static", 30.0, 60.0, 20.0, 70.0),
)
# --------------------------------------------------------------------------

SEASONAL_FEATURES: tuple[str, ...] = ("ndvi", "temperature", "rainfall")
SOIL_FEATURES: tuple[str, ...] = ("soil_ph", "soil_cec", "clay", "silt", "sand")
SEASONS: tuple[str, ...] = tuple(name for name, _ in SEASON_MONTHS)

# Score column names of the fact table, in output order.
SCORE_COLUMNS: tuple[str, ...] = tuple(f"{f}_score" for f in SEASONAL_FEATURES + SOIL_FEATURES)


@dataclass(frozen=True)
class SourceSpec:
    """How one raster source becomes a monthly (or static) per-field value.

    ``temporal`` reduces the images of one month per pixel, ``zonal`` reduces
    the pixels of one polygon. ``scale_factor``/``offset`` are applied to each
    pixel's monthly composite, between the two reductions
    (``value * scale_factor + offset``), as the source applies its band math.
    """

    name: str                      # output column, e.g. "ndvi"
    band: str                      # band name in the pixel table
    temporal: str = "mean"         # "mean" | "sum"
    zonal: str = "mean"            # "mean" | "sum"
    scale_factor: float = 1.0
    offset: float = 0.0
    weight: str | None = None      # pixel column with the share of a pixel that counts
    pixel_deg: float | None = None  # edge of a pixel: it counts by the share of its square that the polygon covers

    def __post_init__(self):
        for kind in (self.temporal, self.zonal):
            if kind not in ("mean", "sum"):
                raise ValueError(f"unknown reducer {kind!r}; use 'mean' or 'sum'")
        if self.weight and self.pixel_deg:
            raise ValueError("a source has a weight column or a pixel size, not both")


# The three monthly sources and the soil bands of the modelled pipeline.
NDVI = SourceSpec("ndvi", band="NDVI")
TEMPERATURE = SourceSpec("temperature", band="temperature_2m", offset=-273.15)
RAINFALL = SourceSpec("rainfall", band="precipitation", temporal="sum", zonal="sum")
SOIL_BANDS: tuple[tuple[str, str], ...] = (
    ("phh2o", "soil_ph"),
    ("cec", "soil_cec"),
    ("clay", "clay"),
    ("silt", "silt"),
    ("sand", "sand"),
)


@dataclass(frozen=True)
class PipelineConfig:
    """Parameters of one pipeline run (the scheduler's params, typed)."""

    start_date: str = DEFAULT_START           # inclusive
    end_date: str = DEFAULT_END               # exclusive for image selection
    raw_db: str = "raw"
    staging_db: str = "staging"
    intermediate_db: str = "intermediate"
    marts_db: str = "marts"
    # Cell edge (degrees) of the spatial index that pairs pixels with polygons.
    cell_deg: float = 0.05
    # Largest spatial index that may be broadcast (rows and estimated bytes);
    # beyond either bound the index is a shuffle join on the cell.
    max_broadcast_rows: int = 1_000_000
    max_broadcast_bytes: int = 256 << 20
    # A load replaces the months of its period, of its polygon set, and nothing
    # else, whatever periods earlier loads had. Without it each run appends, as the
    # original loader does (reruns duplicate rows).
    idempotent_loads: bool = True
    polygon_set: str = "default"
    # A failing check after the build raises; the tables stay for inspection.
    fail_on_checks: bool = True
    series: tuple[SourceSpec, ...] = (NDVI, TEMPERATURE, RAINFALL)
    soil_bands: tuple[tuple[str, str], ...] = SOIL_BANDS
    weights: tuple[tuple[str, float], ...] = WEIGHTS

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)

    @property
    def start(self) -> _dt.date:
        return _dt.date.fromisoformat(self.start_date)

    @property
    def end(self) -> _dt.date:
        return _dt.date.fromisoformat(self.end_date)
