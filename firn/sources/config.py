"""Run settings from YAML: strictly validated dataclasses, enums by name, regional files only of enabled regions."""

from __future__ import annotations

import logging
import sys
from dataclasses import asdict, dataclass, field, fields
from enum import Enum
from pathlib import Path

import yaml


class YearType(Enum):
    CALENDAR = "calendar"
    GLACIOLOGICAL = "glaciological"


class TrendMethod(Enum):
    REGRESSION = "regression"
    START_VS_END = "start_vs_end"


class SeasonalMethod(Enum):
    PROPORTIONAL = "proportional"
    SEASONAL_HOMOGENIZATION = "seasonal_homogenization"


def _checked(kind: type, values: dict) -> dict:
    want, got = {f.name for f in fields(kind) if f.init}, set(values or {})
    if want != got:
        raise KeyError(f"{kind.__name__}: unexpected {sorted(got - want)}, missing {sorted(want - got)}")
    return values


def _plain(x):
    return x.value if isinstance(x, Enum) else {k: _plain(v) for k, v in x.items()} if isinstance(x, dict) else [_plain(v) for v in x] if isinstance(x, list) else x


@dataclass
class RegionConfig:
    region_name: str
    year_type: YearType
    seasonal_correction_dataset: dict
    region_run_settings: dict

    @classmethod
    def load(cls, path: str | Path) -> RegionConfig:
        values = _checked(cls, yaml.safe_load(Path(path).read_text()))
        return cls(**values | {"year_type": YearType(values["year_type"])})

    def settings(self, data_group: str) -> dict[str, list[str]]:
        own = self.region_run_settings.get(data_group) or {}
        return {k: [x for x in v or [] if x is not None] for k, v in own.items()}

    def save(self, folder: str | Path) -> Path:
        Path(folder).mkdir(parents=True, exist_ok=True)
        path = Path(folder) / f"{self.region_name}.yaml"
        path.write_text(yaml.safe_dump(_plain(asdict(self)), sort_keys=False))
        return path


@dataclass
class RunConfig:
    version: int
    config_folder: str
    result_base_path: str
    region_config_base_path: str
    catalogue_path: str
    start_year: int
    end_year: int
    rgi_area_version: int
    datagroups_to_calculate: list
    method_to_extract_trends: TrendMethod
    seasonal_correction_method: SeasonalMethod
    regions: list
    region_configs: list[RegionConfig] = field(init=False, default_factory=list)

    @classmethod
    def load(cls, path: str | Path) -> RunConfig:
        values = _checked(cls, yaml.safe_load(Path(path).read_text()))
        out = cls(**values | {"method_to_extract_trends": TrendMethod(values["method_to_extract_trends"]), "seasonal_correction_method": SeasonalMethod(values["seasonal_correction_method"])})
        for r in out.regions:
            if r["enable_this_region"]:
                own = RegionConfig.load(Path(out.region_config_base_path) / f"{out.config_folder}{out.version}" / r["config_file_path"])
                if own.region_name != r["region_name"]:
                    raise ValueError(f"{r['config_file_path']} is of {own.region_name}, not {r['region_name']}")
                out.region_configs.append(own)
        return out

    def save(self, folder: str | Path) -> list[Path]:
        return [r.save(folder) for r in self.region_configs]


def set_up_logging(path: str | None = None, level: int = logging.INFO) -> None:
    """To standard output, and to a file where one is named."""
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stdout), *([logging.FileHandler(path)] if path else [])]
    logging.basicConfig(level=level, handlers=handlers, format="%(asctime)s %(levelname)s %(name)s %(message)s", force=True)
