"""The stages of a preparation run, each a few Spark jobs.

Two ways lead to balanced classes. Resampling: check, histograms, resample, merge. Weights: check,
split_components, reweight, weighted_merge. Both end with normalise and report.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.config import SPLITS, Component, Preparation, Reweighting, parse
from tallyforge.functions.binning import subdivide
from tallyforge.functions.precision import half
from tallyforge.operators import histograms, interpolation, merging, normalisation, quality, reporting, resampling, reweighting, splitting
from tallyforge.operators.histograms import axes
from tallyforge.operators.ranking import random_order
from tallyforge.session import stored
from tallyforge.sources.tables import full_precision, project, read_sample, with_ints

RESAMPLING = ("check", "histograms", "resample", "merge", "normalise", "report")
WEIGHTING = ("check", "split_components", "reweight", "weighted_merge", "normalise", "report")
STAGES = ("check", "histograms", "resample", "merge", "split_components", "reweight", "weighted_merge", "normalise", "report")
#: Stages that belong to the training split alone.
TRAINING = ("histograms", "split_components", "reweight", "normalise")
#: Columns that only choose the split; histograms are made without cuts on them.
SPLIT_VARIABLES = ("eventnumber", "jetfoldhash")


def _with_field(name: str) -> Callable[[Column, Column], Column]:
    def add(element: Column, weight: Column) -> Column:
        return element.withField(name, weight.cast("float"))

    return add


class Pipeline:
    """One configuration over stored samples. ``out`` is a folder that all executors share; ``key`` tells rows apart."""

    def __init__(self, spark: SparkSession, config: Mapping, out: str, split: str = "train", key: str = "jet_id", seed: int = 42):
        self.spark, self.config, self.out, self.key, self.seed = spark, config, out.rstrip("/"), key, seed
        self.prep: Preparation = parse(config, split)

    def path(self, *parts: str) -> str:
        return "/".join([self.out, *parts])

    @property
    def stages(self) -> tuple[str, ...]:
        """What a whole run does: the way of weights if the configuration has a block for them."""
        return WEIGHTING if self.prep.reweightings else RESAMPLING

    def run(self, stages: Sequence[str] | None = None, region: str | None = None, component: str | None = None) -> None:
        """The chosen stages in order, all by default. ``region`` and ``component`` choose what is resampled."""
        stages = self.stages if stages is None else stages
        unknown = set(stages) - set(STAGES)
        if unknown:
            raise ValueError(f"unknown stages {sorted(unknown)}")
        for stage in STAGES:
            if stage in stages and (self.prep.split == "train" or stage not in TRAINING):
                if stage == "resample":
                    self.resample(region, component)
                elif stage == "histograms":
                    self.histograms(component)
                else:
                    getattr(self, stage)()

    # --- rows ------------------------------------------------------------------------------------------------------
    def sample(self, name: str) -> DataFrame:
        """A sample's rows; of several patterns equally many, chosen at random, if the configuration wants equal_jets."""
        patterns = self.prep.samples[name]
        if not self.prep.equal.get(name):
            rows = read_sample(self.spark, patterns, self.prep.renames)
        else:
            parts = {p: read_sample(self.spark, [p], self.prep.renames) for p in patterns}
            rows = merging.equal_rows(merging.union_components(parts, "__pattern"), "__pattern", self.key, f"{self.seed}equal").drop("__pattern")
        return with_ints(rows, self.prep.ints)

    def routed(self, ignore: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
        """All samples, every row once per component that it belongs to: one scan per sample, whatever the components."""
        chosen = [c for c in self.prep.components if names is None or c.name in names]
        parts = []
        for sample in dict.fromkeys(c.sample for c in chosen):
            own = {c.name: c.cuts.ignore(ignore) for c in chosen if c.sample == sample}
            parts.append(splitting.route(self.sample(sample), own).withColumn("sample_name", F.lit(sample)))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _some(self, rows: DataFrame, of: str, by: Sequence[str] = ()) -> DataFrame:
        """``rows``, or if the configuration limits them for this work, as many random ones (of each group ``by``)."""
        n = self.prep.estimates.get(of)
        if n is None:
            return rows
        return random_order(rows.withColumn("__one", F.lit(1)), ["__one", *by], self.key, f"{self.seed}{of}", "__rank").where(F.col("__rank") <= n).drop("__one", "__rank", "u")

    def check(self) -> None:
        """Raises if the patterns of a sample, or the samples, differ too much in size or have no rows."""
        sizes = [
            read_sample(self.spark, [p]).agg(F.lit(s).alias("sample"), quality.entry_name(F.lit(p)).alias("entry"), F.count(F.lit(1)).alias("n")) for s, patterns in self.prep.samples.items() for p in patterns
        ]
        table = reduce(lambda a, b: a.unionByName(b), sizes)
        factor = self.config.get("deviation_factor", 10.0)
        quality.check_sizes(quality.size_spread(table, "sample"), factor)
        quality.check_sizes(quality.size_spread(table.groupBy("sample").agg(F.sum("n").alias("n")).withColumn("all", F.lit("all")), "all"), factor)

    # --- resampling ------------------------------------------------------------------------------------------------
    def _names(self, region: str | None, component: str | None) -> list[str]:
        """The chosen components; raises for unknown ones and for a component without its region."""
        if component and not region:
            raise ValueError("a component is chosen together with its region")
        names = [c.name for c in self.prep.components if region in (None, c.region) and component in (None, c.name)]
        if not names:
            raise ValueError(f"no component {component or ''} in region {region}")
        return names

    def histograms(self, component: str | None = None) -> None:
        """Counts and probabilities of the resampling bins of all components, or of one and of its region's target."""
        bins = self.prep.resampling.bins
        if component and component not in {c.name for c in self.prep.components}:
            raise ValueError(f"unknown component {component!r}")
        if bins:
            names = None if not component else sorted({component, self._target(next(c for c in self.prep.components if c.name == component)).name})
            hist = histograms.histogram(self._some(self.routed(SPLIT_VARIABLES, names), "hist", ["component"]), ["component"], bins)
            histograms.probabilities(hist, ["component"]).write.mode("overwrite").parquet(self.path("histograms"))
            histograms.check_probabilities(self.spark.read.parquet(self.path("histograms")), ["component"])

    def _target(self, c: Component) -> Component:
        return next(t for t in self.prep.components if (t.region, t.flavour) == (c.region, self.prep.resampling.target))

    def resample(self, region: str | None = None, component: str | None = None) -> None:
        """Draws the rows of all chosen components in one plan, from routed rows that are stored once."""
        names, how = self._names(region, component), self.prep.resampling
        rows = stored(self.routed(names=names), "routed")
        chosen = [c for c in self.prep.components if c.name in names]
        have = {r["component"]: r["n"] for r in rows.groupBy("component").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per component
        fractions = {c.name: self._fraction(c, have.get(c.name, 0)) for c in chosen}
        for c in chosen:
            if c.num_jets >= 0 and int(have.get(c.name, 0) * fractions[c.name]) < c.num_jets:
                raise ValueError(f"fewer rows than requested in {c.name}: {have.get(c.name, 0)} at a fraction of {fractions[c.name]}, {c.num_jets} requested")
        draws = {c.name: c.num_jets if c.num_jets >= 0 else have.get(c.name, 0) for c in chosen}
        plain = {c.name: c.num_jets for c in chosen if how.method is None or c.flavour == how.target}
        parts = []
        if plain:
            parts.append(resampling.cap(rows, "component", plain, self.key, self.seed).select("component", self.key, F.lit(1).cast("bigint").alias("copies")))
        if others := [c for c in chosen if c.name not in plain]:
            # Drawn with a fraction f, n rows come from n / f random ones.
            source = {c.name: -1 if c.num_jets < 0 else int(np.ceil(round(c.num_jets / fractions[c.name], 6))) for c in others}
            few = resampling.cap(rows.select("component", self.key, *how.bins), "component", source, self.key, f"{self.seed}source")
            parts.append(self._drawn(stored(few, "source"), others, draws))
        drawn = reduce(lambda a, b: a.unionByName(b), parts)
        out = self.path("components", self.prep.split)
        rows.join(drawn, ["component", self.key]).hint("rebalance", "component").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("component").parquet(out)
        resampling.upsampling(self.spark.read.parquet(out), ["component"]).write.mode("overwrite").parquet(self.path("upsampling", self.prep.split))

    def _fraction(self, c: Component, have: int) -> float:
        """The share of a component's rows that is drawn: as configured, or a tenth more than needed; 1 for targets and without a method."""
        how = self.prep.resampling
        if how.method is None or c.flavour == how.target or c.num_jets < 0:
            return 1.0
        if how.fraction not in (None, "auto"):
            return float(how.fraction)
        fraction = round(c.num_jets * 1.1 / have, 3) if have else 1.0
        resampling.check_fraction(fraction, how.method)
        return max(fraction, 0.1)

    def _drawn(self, rows: DataFrame, others: Sequence[Component], draws: Mapping[str, int]) -> DataFrame:
        """component, key and copies of the components that are brought to their region's target."""
        how, bins, by = self.prep.resampling, self.prep.resampling.bins, ["component"]
        hist = self.spark.read.parquet(self.path("histograms")).select("component", *axes(bins), "p")
        aims = self.spark.createDataFrame([(c.name, self._target(c).name, draws[c.name]) for c in others], "component string, target string, draws bigint")  # a row per component
        target = hist.withColumnRenamed("component", "target").join(F.broadcast(aims), "target")
        if how.method == "countup":
            return resampling.countup(rows, resampling.bin_quotas(target, F.col("draws"), bins, self.seed, by), bins, self.key, self.seed, by).select(*by, self.key, "copies")
        own = hist.join(F.broadcast(aims.select("component", "draws")), "component")
        ratio = own.join(target.select("component", *axes(bins), F.col("p").alias("aim")), [*by, *axes(bins)], "left").withColumn("ratio", F.coalesce(F.try_divide("aim", "p"), F.lit(0.0)))
        if how.upscale and how.upscale > 1:
            ratio, bins = self._finer(ratio, how.upscale)
        return resampling.importance_sample(rows, ratio, bins, self.key, F.col("draws"), self.seed, by).select(*by, self.key, "copies")

    def _finer(self, ratio: DataFrame, n: int) -> tuple[DataFrame, Mapping]:
        """The ratio grids upscaled, one component's grid a task; pieces of different bin width are upscaled apart."""
        bins, pieces, names = self.prep.resampling.bins, self.prep.resampling.pieces, axes(self.prep.resampling.bins)
        shape = [len(e) - 1 for e in bins.values()]

        def finer(part: pd.DataFrame) -> pd.DataFrame:
            grid = np.zeros(shape)
            grid[tuple(part[b].to_numpy() for b in names)] = part["ratio"]
            fine = interpolation.upscale_regions(grid, pieces, n)
            at = np.indices(fine.shape).reshape(len(shape), -1)
            return pd.DataFrame({"component": part["component"].iloc[0], "draws": part["draws"].iloc[0]} | dict(zip(names, at, strict=True)) | {"ratio": fine.ravel()})

        schema = "component string, draws bigint, " + "".join(f"{b} int, " for b in names) + "ratio double"
        return ratio.groupBy("component").applyInPandas(finer, schema), {v: subdivide(e, n) for v, e in bins.items()}

    def merge(self) -> None:
        """Components united, labelled, repeated as drawn, shuffled and cut into files of the wanted number of rows."""
        rows = self.spark.read.parquet(self.path("components", self.prep.split))
        rows = rows.withColumn("flavour_label", self._label(F.col("component"))).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        self._write(rows.drop("copies"), ["component"], F.concat_ws("/", self.key, "component", "copy"))

    def _label(self, component: Column) -> Column:
        number = F.create_map(*[F.lit(x) for c in self.prep.components for x in (c.name, self.prep.labels[c.flavour])])
        return F.try_element_at(number, component)

    def _write(self, rows: DataFrame, extra: Sequence[str], row: Column, inputs: Mapping[str, Sequence[str]] | None = None) -> None:
        """Output files of shuffled rows; the test split one series of files per sample. A resumed run writes what is missing."""
        for array, cuts in self.prep.nested_cuts.items():
            rows = rows.withColumn(array, merging.select_elements(array, cuts))
        by = ["sample_name"] if self.prep.split == "test" and not self.prep.merge_test_samples else []
        placed = merging.file_index(rows.withColumn("__row", row), "__row", self.prep.rows_per_file or 2**62, self.seed, by, order="__at").drop("__row", *([] if by else ["sample_name"]))
        kept = placed if self.prep.keep_all else project(placed, inputs or self.prep.inputs, ["flavour_label", *extra, "file_no", "__at"])
        out, facts = self.path("output", self.prep.split), self.path("manifest", self.prep.split)
        if self.prep.resume and merging.exists(self.spark, facts) and self._facts() == json.loads(self.spark.read.text(facts).first()[0])["run"]:
            kept = merging.missing_files(self.spark, kept, out, by=by)
        else:
            self._text(json.dumps({"run": self._facts()}), facts)
        merging.write_files(kept, out, by=by, order="__at")
        self._text(merging.manifest(self.merged(), [*by, "file_no"], run=self._facts()), facts)

    def _facts(self) -> str:
        """What the output depends on; a run with other facts is none to resume."""
        config = {k: v for k, v in self.config.items() if k != "resume"}
        return hashlib.sha256(json.dumps([config, self.prep.split, self.key, self.seed], sort_keys=True, default=str).encode()).hexdigest()

    def _text(self, text: str, path: str) -> None:
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    def merged(self) -> DataFrame:
        return self.spark.read.parquet(self.path("output", self.prep.split))

    # --- weights ---------------------------------------------------------------------------------------------------
    def split_components(self) -> None:
        """Every sample routed to the components of all splits, in one scan for the splits with chosen columns and one for the test split, which keeps all."""
        preps = {s: parse(self.config, s) for s in SPLITS}
        for keep_all, splits in ((False, ("train", "val")), (True, ("test",))):
            parts = []
            for sample in dict.fromkeys(c.sample for s in splits for c in preps[s].components):
                own = {f"{s}/{c.name}": c.cuts for s in splits for c in preps[s].components if c.sample == sample}
                routed = splitting.route(self.sample(sample), own, "__to").withColumns({"split": F.split_part("__to", F.lit("/"), F.lit(1)), "component": F.split_part("__to", F.lit("/"), F.lit(2))})
                rows = routed.drop("__to").withColumns({"flavour_label": self._label(F.col("component")), "sample_name": F.lit(sample)})
                parts.append(rows if keep_all else project(rows, self._weighted_inputs(), ["flavour_label", "split", "component", "sample_name"]))
            rows = reduce(lambda a, b: a.unionByName(b), parts)
            short = {n: half(n) for n, t in rows.dtypes if t == "float" and not full_precision(n)}
            splitting.write_split(rows.withColumns(short).hint("rebalance", "split", "component"), self.path("split-components", "all" if keep_all else "chosen"), "split", "component")
        counts = [self.spark.read.parquet(self.path("split-components", f)).groupBy("split", "flavour_label").agg(F.count(F.lit(1)).alias("n")) for f in ("chosen", "all")]
        names = {i: f for f, i in self.prep.labels.items()}
        found = {s: dict.fromkeys(self.prep.flavours, 0) for s in SPLITS}
        for r in counts[0].unionByName(counts[1]).collect():  # a row per split and flavour
            found[r["split"]][names[r["flavour_label"]]] = r["n"]
        self._text(json.dumps({"num_jets": found, "files": {s: self.path("split-components", "all" if s == "test" else "chosen", f"split={s}") for s in SPLITS}}, sort_keys=True), self.path("split-components-manifest"))

    def _weighted_inputs(self) -> dict[str, tuple[str, ...]]:
        """The chosen variables, and those that the weights need."""
        out = {g: tuple(v) for g, v in self.prep.inputs.items()}
        for r in self.prep.reweightings:
            needed = (*r.bins, r.class_var, *(("valid",) if r.group != "jets" else ()))
            out[r.group] = tuple(dict.fromkeys([*out.get(r.group, ()), *(n for n in needed if n != "flavour_label")]))
        return out | {"jets": tuple(dict.fromkeys([*out["jets"], self.key]))}

    def split_rows(self, split: str) -> DataFrame:
        """The rows of a split as the split stage left them."""
        if not merging.exists(self.spark, self.path("split-components-manifest")):
            raise AssertionError("no split components: run the split stage first")
        return self.spark.read.parquet(self.path("split-components", "all" if split == "test" else "chosen")).where(F.col("split") == split).drop("split")

    def reweight(self) -> None:
        """Histograms of the training rows, their targets and the weights of every class and bin, one table per weight."""
        rows = self._some(self.split_rows("train"), "weights", ["flavour_label"])
        made: dict[tuple, DataFrame] = {}
        for r in self.prep.reweightings:
            same = (r.group, tuple((v, tuple(e)) for v, e in r.bins.items()), r.class_var)
            if same not in made:
                hist = histograms.histogram(rows.where(F.col(r.class_var).isNotNull()), [r.class_var], r.bins) if r.group == "jets" else reweighting.nested_histogram(rows, r.group, r.class_var, r.bins)
                made[same] = stored(hist, "histogram")
            target = reweighting.target_histogram(made[same], r.class_var, r.target, r.bins)
            reweighting.check_target(target)
            weights = reweighting.class_weights(made[same], target, r.class_var, r.bins).join(made[same], [r.class_var, *axes(r.bins)], "left")
            weights.write.mode("overwrite").parquet(self.path("weights", r.name))

    def weights(self, r: Reweighting) -> DataFrame:
        if not merging.exists(self.spark, self.path("weights", r.name)):
            raise AssertionError(f"no weights {r.name}: run the reweight stage first")
        return self.spark.read.parquet(self.path("weights", r.name)).drop("n")

    def weighted(self) -> DataFrame:
        """The split's rows with all weights: a column for those of rows, a field of every element for those of nested tables."""
        rows = self.split_rows(self.prep.split)
        for r in self.prep.reweightings:
            if r.group == "jets":
                rows = reweighting.apply_weights(rows, self.weights(r), r.class_var, r.bins, r.name).withColumn(r.name, F.col(r.name).cast("float"))
            else:
                lists = reweighting.weight_lists(self.weights(r), r.class_var, r.bins)
                rows = reweighting.nested_weights(rows, r.group, lists, r.class_var, r.bins, "__w")
                rows = rows.withColumn(r.group, F.zip_with(r.group, "__w", _with_field(r.name))).drop("__w")
        return rows

    def weighted_merge(self) -> None:
        """Rows with their weights, shuffled and cut into files of the wanted number of rows."""
        names = {r.name: r.group for r in self.prep.reweightings}
        rows = self.weighted()
        nested = {g: (*v, *(n for n, at in names.items() if at == g)) for g, v in self.prep.inputs.items() if g != "jets"}
        own = [n for n in self._weighted_inputs()["jets"] if n != "flavour_label"]
        self._write(rows, ["component", *(n for n, at in names.items() if at == "jets")], F.concat_ws("/", self.key, "component"), {"jets": own} | nested)

    # --- statistics ------------------------------------------------------------------------------------------------
    def normalise(self) -> dict:
        """Moments and class weights of the output, also written as JSON; raises if a moment is of no use."""
        rows, out = self._some(self.merged(), "norm"), {"norm": {}, "class": {}, "infinite": {}}
        weights = {r.name for r in self.prep.reweightings}
        numbers = [n for n, t in rows.dtypes if t in ("float", "double") and n not in weights]
        tables = [normalisation.moments(rows, "jets", numbers)]
        arrays = [f.name for f in rows.schema if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
        for array in arrays:
            fields = [f.name for f in rows.schema[array].dataType.elementType if f.dataType.simpleString() in ("float", "double") and f.name not in weights]
            tables.append(normalisation.nested_moments(rows, array, array, fields))
        table = stored(reduce(lambda a, b: a.unionByName(b), tables), "moments")
        normalisation.check_moments(table)
        out["norm"] = normalisation.as_dict(table)
        out["infinite"] = {r["variable"]: r["n_infinite"] for r in table.where("n_infinite > 0").collect()}  # a row per variable
        labels = [c for c in normalisation.label_columns(rows) if c not in (self.key, "file_no", "copy")]
        counts = [normalisation.class_counts(rows, labels)] + [normalisation.nested_class_counts(rows, array, ("valid",)) for array in arrays]
        for r in normalisation.class_weights(reduce(lambda a, b: a.unionByName(b), counts)).orderBy("variable", "label").collect():  # a row per class
            out["class"].setdefault(r["variable"], []).append(r["weight"])
        self._text(json.dumps(out, sort_keys=True), self.path("statistics"))
        return out

    def report(self) -> None:
        """Distributions before and after the run per component: over the full range, and around the joints of regions; weights by class."""
        bins = self.prep.resampling.bins or {v: e for r in self.prep.reweightings if r.group == "jets" for v, e in r.bins.items()}
        after = self._some(self.merged(), "plotting")
        before = self._some(self.routed(), "plotting")
        for v, e in bins.items():
            low, high = min(x for x in e if abs(x) != float("inf")), max(x for x in e if abs(x) != float("inf"))
            bounds = [b for c in self.prep.components if None not in (b := c.cuts.bounds(v))]
            for stage, rows in (("initial", before), (self.prep.split, after)):
                reporting.plot_histogram(rows, ["component"], v, low, high).write.mode("overwrite").parquet(self.path("report", stage, v))
                for i, (start, end) in enumerate(reporting.stitching_windows(sorted(set(bounds)))):
                    near = rows.where((F.col(v) > start) & (F.col(v) < end))
                    reporting.plot_histogram(near, ["component"], v, start, end).write.mode("overwrite").parquet(self.path("report", stage, f"{v}_joint_{i}"))
        for r in self.prep.reweightings:
            for i, v in enumerate(r.bins):
                reporting.project_weights(self.weights(r), r.class_var, r.bins, [i]).write.mode("overwrite").parquet(self.path("report", "weights", r.name, v))
