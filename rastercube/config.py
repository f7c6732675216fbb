"""Build configuration: paths, data and split settings, read from YAML or made in code, always validated."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Paths:
    input_dir: str = ""
    output_dir: str = ""
    boundary: str = ""


@dataclass(frozen=True)
class DataConfig:
    sequence_length: int = 12
    patch_size: int = 128
    stride: int = 64
    purity_threshold: float = 0.90
    max_gap_fraction: float = 0.10
    channel_names: tuple[str, ...] = ()
    target_channel: str = ""
    static_channels: tuple[str, ...] = ()
    test_months: int | None = None


@dataclass(frozen=True)
class SplitConfig:
    method: str = "directional_quantile"
    rotation_deg: float = 0.0
    test_fraction: float = 0.20
    val_fraction: float = 0.15
    min_pixels_per_split: int = 1


@dataclass(frozen=True)
class Config:
    paths: Paths = field(default_factory=Paths)
    data: DataConfig = field(default_factory=DataConfig)
    split: SplitConfig = field(default_factory=SplitConfig)

    def validate(self) -> Config:
        d, s = self.data, self.split
        rules = [
            (d.sequence_length >= 1, "sequence_length must be 1 or more"),
            (d.patch_size > 0 and d.stride > 0, "patch_size and stride must be positive"),
            (0 < d.purity_threshold <= 1, "purity_threshold must be in (0, 1]"),
            (s.method == "directional_quantile", f"unknown split method {s.method}"),
            (0 < s.test_fraction < 1, "test_fraction must be in (0, 1)"),
            (0 < s.val_fraction < 1 - s.test_fraction, "val_fraction must be in (0, 1 - test_fraction)"),
            (len(set(d.channel_names)) == len(d.channel_names), "channel names repeat"),
            (not d.target_channel or d.target_channel in d.channel_names, f"target {d.target_channel} is no channel"),
            (set(d.static_channels) <= set(d.channel_names), "a static channel is no channel"),
        ]
        broken = [why for ok, why in rules if not ok]
        if broken:
            raise ConfigError("; ".join(broken))
        return self

    @property
    def dynamic_channels(self) -> list[str]:
        return [c for c in self.data.channel_names if c not in self.data.static_channels]

    def override(self, **values) -> Config:
        """A copy with some settings of any section changed, validated again."""
        parts = {}
        for section in ("paths", "data", "split"):
            own = {k: v for k, v in values.items() if v is not None and k in {f.name for f in fields(getattr(self, section))}}
            parts[section] = replace(getattr(self, section), **own)
        known = {f.name for section in ("paths", "data", "split") for f in fields(getattr(self, section))}
        if unknown := set(values) - known:
            raise ConfigError(f"unknown settings {sorted(unknown)}")
        return Config(**parts).validate()


def as_yaml(config: Config) -> str:
    """The settings that are in effect, in the form that load() reads."""
    import yaml

    plain = {section: {f.name: (list(v) if isinstance(v := getattr(getattr(config, section), f.name), tuple) else v) for f in fields(getattr(config, section))} for section in ("paths", "data", "split")}
    return yaml.safe_dump(plain, sort_keys=False)


def load(path: str) -> Config:
    """A Config from a YAML file with the sections paths, data and split; unknown keys are errors."""
    import yaml

    with open(path) as f:
        raw = yaml.safe_load(f) or {}
    if unknown := set(raw) - {"paths", "data", "split"}:
        raise ConfigError(f"unknown sections {sorted(unknown)}")
    parts = {}
    for name, kind in (("paths", Paths), ("data", DataConfig), ("split", SplitConfig)):
        own = {k: tuple(v) if isinstance(v, list) else v for k, v in (raw.get(name) or {}).items()}
        if unknown := set(own) - {f.name for f in fields(kind)}:
            raise ConfigError(f"unknown keys in {name}: {sorted(unknown)}")
        parts[name] = kind(**own)
    return Config(**parts).validate()
