"""Schemas that drift between files (problem 5).

Every producer's fields are matched with the columns of the reference table by similarity flooding: a schema graph
of names, types and nesting on either side, first similarities from names and from how often the values agree with
the reference table's, scores propagated along the graphs until they converge, and the consistent correspondences
selected. With them the consecutive dumps of a producer are compared, and all records cast into one table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.session import bounded, cut_lineage, spread

#: Columns of the reference table by nesting, with their type as it is written.
TOP = {
    "pt": "decimal",
    "eta": "decimal",
    "abs_eta": "decimal",
    "mass": "decimal",
    "pt_btagjes": "decimal",
    "eta_btagjes": "decimal",
    "eventnumber": "whole",
    "jetfoldhash": "whole",
    "hadronconeexcltruthlabelid": "whole",
    "flavour_label": "whole",
}
NESTED = {"valid": "truth", "dphi": "decimal", "deta": "decimal", "qoverp": "decimal", "d0": "decimal", "leptonid": "whole"}
QUANTITIES = TOP | {f"tracks.{c}": t for c, t in NESTED.items()}

#: How well a written type fits a column's type.
FITS = {
    ("decimal", "decimal"): 1.0, ("whole", "whole"): 1.0, ("truth", "truth"): 1.0,
    ("whole", "decimal"): 0.7, ("decimal", "whole"): 0.7, ("whole", "truth"): 0.5,
    ("text", "decimal"): 0.4, ("text", "whole"): 0.4, ("text", "truth"): 0.4,
}

#: Weights of the first similarities: agreement of the producer's values, of all producers' values, of the names.
WEIGHTS = (0.6, 0.25, 0.15)
#: A correspondence is checked by values: it holds only if so large a share of the producer's values agrees with the reference table.
AGREEMENT = 0.9
#: Score that a field without values to check needs, by its name, type and place alone.
UNCHECKED = 0.5
#: Producers whose graphs are flooded together.
PRODUCERS_AT_ONCE = 64
#: Dumps of a producer that are put in order together.
DUMPS_PER_BUCKET = 1024


#: Words for truth values.
TRUTHS = {"true": 1.0, "yes": 1.0, "y": 1.0, "t": 1.0, "false": 0.0, "no": 0.0, "n": 0.0, "f": 0.0}
#: Written types from the weakest to the strongest claim; a field of several slots has the strongest of them.
KINDS = ("whole", "decimal", "truth", "text", "nested")
RECORD_SCHEMA = "producer string, seq_no int, dump_id bigint, rec_no int, jet_id bigint, fields array<struct<name string, kind string, mark double, vals array<double>>>"


#: Written type of each Python type that JSON gives; all others are nested.
KIND_OF = {type(None): None, bool: "truth", int: "whole", float: "decimal", str: "text"}


def _number(v: object) -> float | None:
    """A JSON value as a number: truth values and their usual words are 1 and 0; None where it is none."""
    if v.__class__ is str:
        word = v.strip().lower()
        if word in TRUTHS:
            return TRUTHS[word]
        try:
            return float(word)
        except ValueError:
            return None
    return float(v) if isinstance(v, (bool, int, float)) else None


def _objects(payload: str | None) -> list[dict]:
    """The objects of a payload: of an array, or one a line; lines that are none are passed over."""
    body = (payload or "").strip()
    if body.startswith("["):
        try:
            found = json.loads(body)
        except ValueError:
            found = []
    else:
        found = []
        for line in body.splitlines():
            try:
                found.append(json.loads(line))
            except ValueError:
                continue
    return [x for x in found if isinstance(x, dict)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        source, number, ids, ends = [], [], [], [0]
        names, kinds, marks, vals, val_ends = [], [], [], [], [0]

        def add(name: str, values: list) -> None:
            known = {KIND_OF.get(v.__class__, "nested") for v in values} - {None}
            numbers = [v if v.__class__ is float else _number(v) for v in values]
            names.append(name)
            kinds.append(max(known, key=KINDS.index) if len(known) > 1 else known.pop() if known else None)
            marks.append(None if None in numbers else reduce(lambda a, v: 2.0 * a + v, numbers, 0.0))
            vals.extend(numbers)
            val_ends.append(len(vals))

        for row, payload in enumerate(batch.column("payload").to_pylist()):
            for n, record in enumerate(_objects(payload)):
                slots = [s for s in t if isinstance(s, dict)] if isinstance(t := record.get("tracks"), list) else []
                jet = _number(record.get("jet_id"))
                source.append(row)
                number.append(n)
                ids.append(int(jet) if jet is not None and jet == jet // 1 else None)
                for k, v in record.items():
                    if k not in ("jet_id", "tracks"):
                        add(k, [v])
                for k in dict.fromkeys(k for s in slots for k in s):
                    add(f"tracks.{k}", [s.get(k) for s in slots])
                ends.append(len(names))
        at = pa.array(source, pa.int32())
        whose = [batch.column(c).take(at) for c in ("producer", "seq_no", "dump_id")]
        lists = pa.ListArray.from_arrays(pa.array(val_ends, pa.int32()), pa.array(vals, pa.float64()))
        fields = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.string()), pa.array(marks, pa.float64()), lists], ["name", "kind", "mark", "vals"])
        yield pa.RecordBatch.from_arrays(
            [*whose, pa.array(number, pa.int32()), pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)],
            names=["producer", "seq_no", "dump_id", "rec_no", "jet_id", "fields"],
        )


def records(dumps: DataFrame) -> DataFrame:
    """One row per record of every dump: producer, seq_no, dump_id, rec_no, jet_id and its fields.

    ``fields`` holds name, kind (text, truth, whole, decimal; null if only nulls), vals, the values as numbers (one,
    or one per slot for a field inside the list ``tracks``), and mark, one number made of them. A payload is an array
    of objects or one object a line; null, empty and unreadable payloads and lines that are no objects give no rows.
    Read in Python: Spark's functions for JSON of unknown fields (variant) took seven times as long here.
    """
    whose = [F.col("producer"), F.col("seq_no").cast("int"), F.col("dump_id").cast("bigint")]
    return spread(dumps.select(*whose, "payload")).mapInArrow(_parse, RECORD_SCHEMA)


def _reference(jets: DataFrame) -> DataFrame:
    """The mark of every quantity of every jet, each jet once."""
    top = [F.col(c).cast("double").alias(f"q_{c}") for c in TOP]

    def mark(column: str) -> Column:
        return F.aggregate("tracks", F.lit(0.0), lambda a, t: a * 2 + t[column].cast("double"))

    rows = jets.where("jet_id is not null").select("jet_id", *top, *[mark(c).alias(f"q_tracks.{c}") for c in NESTED])
    return rows.groupBy("jet_id").agg(*[F.max(f"`q_{q}`").alias(f"q_{q}") for q in QUANTITIES])


def _agrees(value: Column, true: Column) -> Column:
    """Equal but for rounding: to whole numbers where they are large, to three places where they are small."""
    return F.abs(value - true) <= F.when(F.abs(true) > 100, 0.51).otherwise(0.0081)


def agreement(recs: DataFrame, jets: DataFrame) -> DataFrame:
    """Per producer, field name and quantity: of how many values (n) how many agree (hits) with the table jets."""
    rows = (
        recs.where("jet_id is not null")
        .join(_reference(jets), "jet_id")
        .select("producer", F.explode("fields").alias("f"), *[F.col(f"`q_{q}`") for q in QUANTITIES])
        .select("producer", F.col("f.name").alias("name"), F.array_position(F.array(*map(F.lit, KINDS)), F.col("f.kind")).alias("kind"), F.col("f.mark").alias("v"), *[F.col(f"`q_{q}`") for q in QUANTITIES])
        .where("v is not null")
    )
    nested = F.col("name").startswith("tracks.")
    count = []
    for i, q in enumerate(QUANTITIES):
        true, here = F.col(f"`q_{q}`"), nested if q.startswith("tracks.") else ~nested
        count += [F.count(F.when(here & true.isNotNull() & ~F.isnan(true), 1)).alias(f"n{i}"), F.count(F.when(here & _agrees(F.col("v"), true), 1)).alias(f"h{i}")]
    wide = rows.groupBy("producer", "name").agg(F.max("kind").alias("kind"), *count)
    each = F.array(*[F.struct(F.lit(q).alias("quantity"), F.col(f"n{i}").alias("n"), F.col(f"h{i}").alias("hits")) for i, q in enumerate(QUANTITIES)])
    kind = F.try_element_at(F.array(*map(F.lit, KINDS)), F.nullif(F.col("kind").cast("int"), F.lit(0)))
    return wide.select("producer", "name", kind.alias("kind"), F.inline(each)).where("n > 0")


def _trigrams(name: str) -> set[str]:
    s = f"  {name.lower().rpartition('.')[2].replace('_', '')} "
    return {s[i : i + 3] for i in range(len(s) - 2)}


def name_similarity(a: str, b: str) -> float:
    """Share of common letter triples."""
    x, y = _trigrams(a), _trigrams(b)
    return len(x & y) / len(x | y)


def flood(pairs: pd.DataFrame, tolerance: float = 1e-3, rounds: int = 200) -> np.ndarray:
    """Similarities of field and column pairs after flooding, each producer's graph on its own.

    ``pairs`` has producer, name, kind, quantity and first (the first similarity), sorted by producer. Neighbours of
    a pair (field, column) are the pair of their types and the pair of their parents (the record or the list
    ``tracks``); a pair's score flows to its neighbours in equal shares, all scores of a producer are divided by its
    largest, until they stand still.
    """
    producer = pd.factorize(pairs["producer"], use_na_sentinel=False)[0]
    starts = np.flatnonzero(np.r_[True, producer[1:] != producer[:-1]])
    first = pairs["first"].to_numpy(float)
    column_type = pairs["quantity"].map(QUANTITIES)
    fits = np.array([FITS.get(x, 0.1) for x in zip(pairs["kind"], column_type, strict=True)])
    score, graphs = first.copy(), []
    for by, start in (([pairs["kind"].fillna(""), column_type], fits), ([pairs["name"].str.contains(".", regex=False)], np.ones(len(pairs)))):
        code = pd.DataFrame({"p": producer} | dict(enumerate(by))).groupby(["p", *range(len(by))], sort=True).ngroup().to_numpy()
        size = np.bincount(code)
        at_start = np.zeros(len(size))
        at_start[code] = start
        owner = np.zeros(len(size), int)
        owner[code] = producer
        graphs.append({"code": code, "size": size, "start": at_start, "now": at_start.copy(), "owner": owner})
    for _ in range(rounds):
        new = first + score + sum(((g["start"] + g["now"]) / g["size"])[g["code"]] for g in graphs)
        top = np.maximum.reduceat(new, starts)
        for g in graphs:
            g["now"] = g["start"] + g["now"] + np.bincount(g["code"], weights=(first + score) / len(graphs), minlength=len(g["size"]))
            np.maximum.at(top, g["owner"], g["now"])
        new = new / top[producer]
        for g in graphs:
            g["now"] = g["now"] / top[g["owner"]]
        moved = np.abs(new - score).max()
        score = new
        if moved < tolerance:
            break
    return score


def choose(part: pd.DataFrame) -> pd.DataFrame:
    """The consistent correspondences of some producers: producer, name, quantity, score.

    ``part`` has a row per producer, field and column with kind, n and hits (values, and those that agree), everywhere
    (the agreement over all producers) and together (the fields that occur in a dump with this one). Pairs are taken
    by their score after flooding: a field gets one column, and no column that a field of the same dump has already,
    unless all it could have are taken. Pairs with values must agree with them, others need a high score.
    """
    part = part.sort_values(["producer", "name", "quantity"], ignore_index=True)
    alike = {x: name_similarity(*x) for x in set(zip(part["name"], part["quantity"], strict=True))}
    names = np.array([alike[x] for x in zip(part["name"], part["quantity"], strict=True)])
    everywhere = part["everywhere"].fillna(0.0).to_numpy(float)
    here = (part["hits"] / part["n"].where(part["n"] > 0)).to_numpy(float)
    checked = ~np.isnan(here)
    part["first"] = WEIGHTS[0] * np.where(checked, here, everywhere) + WEIGHTS[1] * everywhere + WEIGHTS[2] * names
    part["score"] = flood(part)
    able = part[np.where(checked, here >= AGREEMENT, part["score"] >= UNCHECKED)].sort_values(["score", "first", "quantity"], ascending=[False, False, True])
    chosen: dict[tuple, tuple] = {}
    second = []
    for free in (True, False):
        for p, name, q, score, together in second if not free else zip(able["producer"], able["name"], able["quantity"], able["score"], able["together"], strict=True):
            if (p, name) in chosen:
                continue
            if free and any(chosen.get((p, other), (None,))[0] == q for other in together):
                second.append((p, name, q, score, together))
            else:
                chosen[p, name] = (q, score)
    return pd.DataFrame([(*k, *v) for k, v in chosen.items()], columns=["producer", "name", "quantity", "score"])


def correspondences(schemas: DataFrame, recs: DataFrame, jets: DataFrame) -> DataFrame:
    """The column (``quantity``) that each producer's field carries: producer, name, quantity, score.

    ``schemas`` has producer and fields (name, kind) of every dump. Producers are flooded together by hash, some
    PRODUCERS_AT_ONCE; a group has as many rows as its producers have distinct fields, times the columns. The result
    is stored.
    """
    seen = agreement(recs, jets)
    overall = seen.groupBy("name", "quantity").agg((F.sum("hits") / F.sum("n")).alias("everywhere"))
    # Few versions of a producer's schema are different: pairs of fields are made of these.
    versions = schemas.groupBy("producer", F.transform("fields", lambda f: f["name"]).alias("names")).agg(F.first("fields").alias("fields"))
    fields = (
        versions.select("producer", "names", F.explode("fields").alias("f"))
        .groupBy("producer", F.col("f.name").alias("name"))
        .agg(F.max(F.array_position(F.array(*map(F.lit, KINDS)), F.element_at(F.split("f.kind", r"\+"), -1))).alias("kind"), F.array_distinct(F.flatten(F.collect_set("names"))).alias("together"))
    )
    top, inner = (F.array(*map(F.lit, [q for q in QUANTITIES if q.startswith("tracks.") == nested])) for nested in (False, True))
    kind = F.try_element_at(F.array(*map(F.lit, KINDS)), F.nullif(F.col("kind").cast("int"), F.lit(0)))
    able = fields.select(
        "producer", "name", kind.alias("kind"), F.array_remove(F.col("together"), F.col("name")).alias("together"), F.explode(F.when(F.col("name").startswith("tracks."), inner).otherwise(top)).alias("quantity")
    )
    n = seen.select(F.col("producer").alias("__p"), F.col("name").alias("__n"), F.col("quantity").alias("__q"), "n", "hits")
    same = F.col("producer").eqNullSafe(F.col("__p")) & (F.col("name") == F.col("__n")) & (F.col("quantity") == F.col("__q"))
    pairs = able.join(n, on=same, how="left").join(overall, ["name", "quantity"], "left").select("producer", "name", "kind", "together", "quantity", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hits", F.lit(0)).alias("hits"), "everywhere")
    groups = schemas.agg(F.ceil(F.approx_count_distinct("producer") / F.lit(PRODUCERS_AT_ONCE)).alias("g")).scalar()
    bucket = F.pmod(F.xxhash64("producer"), F.greatest(groups, F.lit(1))).alias("bucket")
    return cut_lineage(pairs.groupBy(bucket).applyInPandas(choose, "producer string, name string, quantity string, score double"))


SCHEMA_SCHEMA = "producer string, seq_no int, dump_id bigint, fields array<struct<name string, kind string>>"


def _type_of(known: set[str]) -> str | None:
    """One type for all values of a field in a dump: whole numbers among numbers with decimal point make no other type."""
    return "+".join(sorted(known - {"whole"} if "decimal" in known else known)) or None


def _parse_schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, ends, names, kinds = [], [0], [], []
        for row, payload in enumerate(batch.column("payload").to_pylist()):
            if not (found := _objects(payload)):
                continue
            seen: dict[str, set] = {}
            for record in found:
                for k, v in record.items():
                    if k == "tracks" and isinstance(v, list):
                        for slot in v:
                            for name, x in slot.items() if isinstance(slot, dict) else ():
                                seen.setdefault(f"tracks.{name}", set()).add(x.__class__)
                    elif k not in ("jet_id", "tracks"):
                        seen.setdefault(k, set()).add(v.__class__)
            keep.append(row)
            for name in sorted(seen):
                names.append(name)
                kinds.append(_type_of({KIND_OF.get(c, "nested") for c in seen[name]} - {None}))
            ends.append(len(names))
        at = pa.array(keep, pa.int32())
        fields = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.string())], ["name", "kind"])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(at) for c in ("producer", "seq_no", "dump_id")], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)],
            names=["producer", "seq_no", "dump_id", "fields"],
        )


def schemas_of(dumps: DataFrame) -> DataFrame:
    """Per dump that holds records: producer, seq_no, dump_id and its fields (name, kind), by name."""
    whose = [F.col("producer"), F.col("seq_no").cast("int"), F.col("dump_id").cast("bigint")]
    return spread(dumps.select(*whose, "payload")).mapInArrow(_parse_schemas, SCHEMA_SCHEMA)


def _schemas(each: DataFrame, columns: DataFrame) -> DataFrame:
    """``each`` (of ``schemas_of``) with its fields (``now``) as (name, kind, quantity), by name."""
    named = each.select("producer", "seq_no", "dump_id", F.inline_outer("fields"))
    carried = bounded(columns.select(F.col("producer").alias("__p"), F.col("name").alias("__n"), "quantity"))
    same = F.col("producer").eqNullSafe(F.col("__p")) & (F.col("name") == F.col("__n"))
    field = F.when(F.col("name").isNotNull(), F.struct("name", "kind", "quantity"))
    return named.join(carried, on=same, how="left").groupBy("producer", "seq_no", "dump_id").agg(F.array_sort(F.collect_list(field)).alias("now"))


def _with_preceding(schemas: DataFrame) -> DataFrame:
    """Adds ``old``, the fields of the producer's preceding dump (null for its first), by seq_no, then dump_id.

    A producer's dumps are cut into buckets of consecutive seq_no; only the last dump of each bucket is handed on
    to the next, so that no producer's dumps all meet in one task. Null seq_no come first.
    """
    keyed = schemas.withColumn("__bucket", F.coalesce(F.floor(F.col("seq_no") / F.lit(DUMPS_PER_BUCKET)), F.lit(-(2**40))))
    order = F.struct(F.col("seq_no"), F.col("dump_id"))
    last = keyed.groupBy("producer", "__bucket").agg(F.max(F.struct(order.alias("o"), F.col("now"))).alias("__last"))
    handed = last.select(
        F.col("producer").alias("__p"),
        F.col("__bucket").alias("__b"),
        F.lag("__last.now").over(Window.partitionBy("producer").orderBy("__bucket")).alias("__before"),
    )
    inside = Window.partitionBy("producer", "__bucket").orderBy(F.col("seq_no").asc_nulls_first(), "dump_id")
    same = F.col("producer").eqNullSafe(F.col("__p")) & (F.col("__bucket") == F.col("__b"))
    return (
        keyed.withColumn("__lag", F.lag("now").over(inside))
        .join(handed, on=same, how="inner")
        .select("producer", "seq_no", "dump_id", "now", F.coalesce("__lag", "__before").alias("old"))
    )


def schema_changes(dumps: DataFrame, jets: DataFrame) -> DataFrame:
    """Every change between consecutive dumps of a producer: dump_id (of the later), field, change.

    change is added, removed, renamed or retyped; a field that is renamed and retyped gives two rows. A field is
    renamed if it goes, another comes in the same dump, and both carry the same quantity of their jets; of several
    candidates the first by name. A field whose values in a dump are all null has no type there, so it is not
    retyped. Dumps without records are passed over; a null producer is a producer of its own; extra columns are
    ignored; an empty table gives no rows.
    """
    each = cut_lineage(schemas_of(dumps))
    pairs = _with_preceding(_schemas(each, correspondences(each, records(dumps), jets))).where("old is not null")
    gone = F.filter("old", lambda o: ~F.exists("now", lambda n: n["name"] == o["name"]))
    came = F.filter("now", lambda n: ~F.exists("old", lambda o: n["name"] == o["name"]))
    step = pairs.select("dump_id", "old", "now", gone.alias("gone"), came.alias("came"))
    # One renaming per quantity: its first field that goes with its first field that comes.
    first = lambda fields, q: F.try_element_at(F.filter(fields, lambda f: f["quantity"] == q), F.lit(1))
    carried = F.array_distinct(F.array_compact(F.transform("gone", lambda o: o["quantity"])))
    moves = F.filter(F.transform(carried, lambda q: F.struct(first("gone", q).alias("o"), first("came", q).alias("n"))), lambda m: m["n"].isNotNull())
    step = step.withColumn("moves", moves)
    row = lambda name, change: F.struct(name.alias("field"), F.lit(change).alias("change"))
    retyped_move = F.filter("moves", lambda m: m["o"]["kind"] != m["n"]["kind"])
    retyped = F.filter("old", lambda o: F.exists("now", lambda n: (n["name"] == o["name"]) & (n["kind"] != o["kind"])))
    out = F.concat(
        F.transform(F.filter("gone", lambda o: ~F.exists("moves", lambda m: m["o"]["name"] == o["name"])), lambda o: row(o["name"], "removed")),
        F.transform(F.filter("came", lambda n: ~F.exists("moves", lambda m: m["n"]["name"] == n["name"])), lambda n: row(n["name"], "added")),
        F.transform("moves", lambda m: row(m["o"]["name"], "renamed")),
        F.transform(retyped_move, lambda m: row(m["o"]["name"], "retyped")),
        F.transform(retyped, lambda o: row(o["name"], "retyped")),
    )
    return step.select("dump_id", F.explode(out).alias("c")).select("dump_id", "c.field", "c.change")


def unified(dumps: DataFrame, jets: DataFrame) -> DataFrame:
    """The records of all dumps under the names and types of the reference table.

    One row per record with dump_id, rec_no, jet_id, a column per quantity (null where the record lacks it or it
    cannot be read as a number) and tracks, an array of its slots. Fields that correspond to no column are left out;
    of several fields that carry one quantity the first by name with a value counts. A dump delivered twice (equal
    producer, seq_no and payload) counts once.
    """
    # A dump delivered again counts once: the first of equal ones by dump_id.
    first = dumps.groupBy("producer", "seq_no", F.sha2("payload", 256).alias("same")).agg(F.min("dump_id").alias("dump_id")).select("dump_id")
    dumps = dumps.join(first, "dump_id", "left_semi")
    recs = records(dumps)
    names = correspondences(schemas_of(dumps), recs, jets).groupBy(F.col("producer").alias("__p")).agg(F.map_from_entries(F.collect_list(F.struct("name", "quantity"))).alias("__map"))
    rows = recs.join(bounded(names), on=F.col("producer").eqNullSafe(F.col("__p")), how="left").select(
        "dump_id",
        "rec_no",
        "jet_id",
        F.transform(F.array_sort("fields"), lambda f: F.struct(F.try_element_at(F.col("__map"), f["name"]).alias("q"), f["vals"].alias("vals"))).alias("__f"),
    )
    cast = {"decimal": "float", "whole": "int", "truth": "boolean"}
    value = lambda q: F.try_element_at(F.filter("__f", lambda f: (f["q"] == q) & F.exists(f["vals"], lambda v: v.isNotNull())), F.lit(1))["vals"]
    # One array per inner column first: the slots are then zipped by place.
    zipped = rows.select(
        "dump_id",
        "rec_no",
        "jet_id",
        *[F.get(value(c), 0).try_cast(cast[t]).alias(c) for c, t in TOP.items()],
        *[value(f"tracks.{c}").alias(f"__{c}") for c in NESTED],
    )
    slots = F.greatest(*[F.coalesce(F.size(f"__{c}"), F.lit(0)) for c in NESTED])
    places = F.when(slots > 0, F.sequence(F.lit(0), slots - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    tracks = F.transform(places, lambda i: F.struct(*[F.get(F.col(f"__{c}"), i).try_cast(cast[t]).alias(c) for c, t in NESTED.items()]))
    return zipped.select("dump_id", "rec_no", "jet_id", *TOP, tracks.alias("tracks"))

