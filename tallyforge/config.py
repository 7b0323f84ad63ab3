"""The declarative configuration: a dictionary or YAML document turned into checked objects."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from tallyforge.functions.binning import edges, with_overflow
from tallyforge.functions.cuts import Cut, Cuts
from tallyforge.operators.resampling import validate
from tallyforge.operators.reweighting import TARGETS, weight_name

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class Component:
    """Region, sample and flavour with a quota of rows (-1: all)."""

    region: str
    sample: str
    flavour: str
    cuts: Cuts
    num_jets: int

    @property
    def name(self) -> str:
        return f"{self.region}_{self.sample}_{self.flavour}"


@dataclass(frozen=True)
class Resampling:
    method: str | None = None
    target: str | None = None
    bins: Mapping[str, list[float]] = field(default_factory=dict)
    upscale: int | None = None
    fraction: float | str | None = 1.0
    pieces: tuple[tuple[int, ...], ...] = ()

    def __post_init__(self) -> None:
        validate(self.method, self.upscale)
        if not (self.fraction in (None, "auto") or (isinstance(self.fraction, (int, float)) and self.fraction > 0)):
            raise ValueError(f"sampling_fraction must be auto or positive, not {self.fraction!r}")
        if self.method in ("pdf", "countup") and (not self.target or not self.bins):
            raise ValueError(f"method {self.method} needs a target and variables")


@dataclass(frozen=True)
class Reweighting:
    """Weights that bring the classes' histograms of some variables to a target."""

    group: str
    bins: Mapping[str, list[float]]
    class_var: str
    target: object

    def __post_init__(self) -> None:
        if self.target is None or not (isinstance(self.target, (int, list, tuple)) or self.target in TARGETS):
            raise ValueError(f"class_target must be a class, a list of classes or one of {TARGETS}, not {self.target!r}")

    @property
    def name(self) -> str:
        return weight_name(self.group, list(self.bins), self.class_var, self.target)


@dataclass(frozen=True)
class Preparation:
    """All that a run needs for one split."""

    split: str
    samples: Mapping[str, tuple[str, ...]]
    flavours: Mapping[str, Cuts]
    components: tuple[Component, ...]
    resampling: Resampling
    inputs: Mapping[str, tuple[str, ...]]
    keep_all: bool
    rows_per_file: int | None
    nested_cuts: Mapping[str, Cuts]
    renames: Mapping[str, str]
    ints: Mapping[str, Mapping[int, int]] = field(default_factory=dict)
    equal: Mapping[str, bool] = field(default_factory=dict)
    reweightings: tuple[Reweighting, ...] = ()
    estimates: Mapping[str, int] = field(default_factory=dict)
    merge_test_samples: bool = False
    resume: bool = False

    @property
    def labels(self) -> dict[str, int]:
        """Number of each flavour: its place."""
        return {f: i for i, f in enumerate(self.flavours)}


def load_yaml(path: str | Path) -> dict:
    """A YAML document; ``!include name`` stands for another one in the same folder."""
    import yaml

    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"no configuration at {path}")

    class Loader(yaml.SafeLoader):
        pass

    def include(loader: yaml.Loader, node: yaml.Node) -> object:
        return load_yaml(path.parent / loader.construct_scalar(node))

    Loader.add_constructor("!include", include)
    return yaml.load(path.read_text(), Loader)  # noqa: S506


def _quota(block: Mapping, split: str) -> int:
    """Rows of a split: its own number, or for val and test a tenth of the training rows; -1 stays -1."""
    train = int(block["num_jets"])
    if split == "train":
        return train
    return int(block.get(f"num_jets_{split}", -1 if train == -1 else train // 10))


def _reweightings(config: Mapping) -> tuple[Reweighting, ...]:
    block = config.get("reweighting") or {}
    out = []
    for r in block.get("reweights") or ():
        bins = {v: edges(r["bins"][v]) for v in r["reweight_vars"]}
        out.append(Reweighting(r["group"], {v: with_overflow(e) if r.get("add_overflow", True) else e for v, e in bins.items()}, r["class_var"], r.get("class_target")))
    return tuple(out)


def _estimates(config: Mapping) -> dict[str, int]:
    """Most rows for histograms, moments, distributions and weights; without an own number all rows are used."""
    block = config.get("global") or {}
    found = {k: block.get(f"num_jets_estimate_{k}") for k in ("hist", "norm", "plotting")} | {"weights": (config.get("reweighting") or {}).get("num_jets_estimate")}
    for k, n in found.items():
        if n is not None and n <= 0:
            raise ValueError(f"the number of rows for {k} must be positive, not {n}")
    return {k: n for k, n in found.items() if n is not None}


def parse(config: Mapping, split: str = "train") -> Preparation:
    """Checked objects for one split. Regions, resampling and the selection of variables do not apply to the test split."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}")
    test = split == "test"
    flavours = {f["name"]: Cuts.of(f["cuts"]) for f in config["flavours"]}
    samples = {s["name"]: tuple([s["pattern"]] if isinstance(s["pattern"], str) else s["pattern"]) for s in config["samples"]}
    regions = {r["name"]: Cuts.of(r.get("cuts")) for r in config["regions"]}
    block = config.get("resampling") or {}
    bins = {v: edges(b["bins"]) for v, b in (block.get("variables") or {}).items()}
    method = None if test else block.get("method")
    resampling = Resampling(None if method == "none" else method, block.get("target"), {} if test else bins, block.get("upscale_pdf"), block.get("sampling_fraction", 1.0), tuple(tuple(int(piece[2]) for piece in b["bins"]) for b in (block.get("variables") or {}).values()))
    cuts = Cuts.of((config.get("global_cuts") or {}).get("common")) + Cuts.of((config.get("global_cuts") or {}).get(split))
    if not test:
        cuts += Cuts(tuple(Cut(v, op, e) for v, b in bins.items() for op, e in ((">", b[0]), ("<", b[-1]))))
    components = []
    for c in config["components"]:
        if "equal_jets" in c:
            raise AssertionError("equal_jets belongs to a sample, not to a component")
        for name, known in (("region", regions), ("sample", samples)):
            if c[name] not in known:
                raise ValueError(f"unknown {name} {c[name]!r}")
        for f in c["flavours"]:
            if f not in flavours:
                raise ValueError(f"unknown flavour {f!r}")
            own = cuts + flavours[f] + (Cuts() if test else regions[c["region"]])
            if not isinstance(c.get("num_jets"), int):
                raise ValueError(f"num_jets of {c['region']} must be a whole number")
            components.append(Component(c["region"], c["sample"], f, own, _quota(c, split)))
    if resampling.method:
        _check_targets(components, resampling.target)
        _check_ratios(components)
    variables = {g: tuple(dict.fromkeys([*v.get("inputs", ()), *v.get("labels", ()), *(bins if g == "jets" else ()), *(() if g == "jets" else ("valid",))])) for g, v in config["variables"].items()}
    nested = {g: Cuts.of(v["selection"]) for g, v in config["variables"].items() if v.get("selection")}
    transform = config.get("transform") or {}
    several = {s["name"]: s.get("equal_jets", True) and len(samples[s["name"]]) > 1 for s in config["samples"]}
    return Preparation(
        split, samples, flavours, tuple(components), resampling, variables, test, config.get("num_jets_per_output_file"), nested, transform.get("variable_map") or {}, transform.get("ints_map") or {},
        several, _reweightings(config), _estimates(config), bool((config.get("global") or {}).get("merge_test_samples")), bool(config.get("resume")),
    )


def _check_targets(components: list[Component], target: str | None) -> None:
    for region in {c.region for c in components}:
        if sum(c.flavour == target for c in components if c.region == region) != 1:
            raise AssertionError(f"not exactly one target {target!r} in region {region}")


def _check_ratios(components: list[Component]) -> None:
    """The flavours' shares of the quotas must be the same in all regions."""
    shares: dict[str, dict[str, float]] = {}
    for c in components:
        if c.num_jets < 0:
            return
        own = shares.setdefault(c.region, {})
        own[c.flavour] = own.get(c.flavour, 0) + c.num_jets
    normal = [{f: n / sum(s.values()) for f, n in s.items()} for s in shares.values() if sum(s.values())]
    for other in normal[1:]:
        if other.keys() != normal[0].keys() or any(abs(other[f] - normal[0][f]) > 1e-5 for f in other):
            raise ValueError(f"flavour shares differ between regions: {normal[0]} and {other}")


def cuts_of_all_splits(config: Mapping) -> dict[str, dict[str, Cuts]]:
    """For every sample, the cuts of each split and component: what one scan of the sample has to route."""
    out: dict[str, dict[str, Cuts]] = {}
    for split in SPLITS:
        for c in parse(config, split).components:
            out.setdefault(c.sample, {})[f"{split}_{c.name}"] = c.cuts
    return out
