"""Re-filing a combined release by year, with names that collide with nothing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import COMBINED_YEARS, base_name, stem, suffix, year_in_name
from tidemark.functions.text import let, quoted
from tidemark.operators.skew import rank_within, skew_join
from tidemark.session import materialise, small_side
from tidemark.sources.binary import normal_folder, normal_path

# What numbered names are made of: ``<head>_<number><tail>``. Two kinds of item with one head
# and tail share their numbers.
_FORM = ["folder", "head", "tail"]
_NAME = ["folder", "name"]


def free_names(incoming: DataFrame, taken: DataFrame) -> DataFrame:
    """Give every incoming item a name of its own: adds ``new_name``.

    `incoming` is (folder, name, is_dir, item) with `item` unique and deciding the
    order; `taken` is (folder, name). Files and folders share one name space. The first
    item of a name keeps it if it is free. The others become ``stem_1.ext``,
    ``stem_2.ext``, … in order, leaving out numbers that are taken, by present files or
    by natural names of other items. Folders take the number at the end of the whole
    name. Only names that are wanted twice or present already are numbered, and only
    numbers in their forms are looked for. Both tables are read more than once and
    should be stored ones.
    """
    used = taken.select(*_NAME).distinct()
    natural = incoming.groupBy(*_NAME).agg(F.count(F.lit(1)).alias("_items"), F.min("item").alias("_first"))
    natural = natural.join(used.withColumn("_used", F.lit(True)), _NAME, "left").withColumn("_used", F.coalesce("_used", F.lit(False)))
    crowded = materialise(natural.where("_used or _items > 1"))
    if crowded.isEmpty():
        return incoming.withColumn("new_name", F.col("name"))
    items = skew_join(incoming.select(*_NAME, "is_dir", "item"), crowded, _NAME, "inner", right_stored=True)
    items = items.where("_used or item <> _first").select(
        "folder",
        F.when(F.col("is_dir"), F.col("name")).otherwise(stem(F.col("name"))).alias("head"),
        F.when(F.col("is_dir"), F.lit("")).otherwise(suffix(F.col("name"))).alias("tail"),
        "item",
    )
    items = materialise(items)
    forms = materialise(items.groupBy(*_FORM).agg(F.count(F.lit(1)).alias("_items")))
    numbers_taken = materialise(_numbers_taken(used.unionByName(natural.select(*_NAME)).distinct(), forms))
    numbers = _free_numbers(items, numbers_taken, forms)
    renamed = numbers.select(F.col("item").alias("_item"), F.concat("head", F.lit("_"), F.col("_number").cast("string"), "tail").alias("_name"))
    renamed = small_side(materialise(renamed))
    return incoming.join(renamed, F.col("item") == F.col("_item"), "left").select(
        *incoming.columns, F.coalesce("_name", "name").alias("new_name")
    )


def _numbers_taken(names: DataFrame, forms: DataFrame) -> DataFrame:
    """Numbers that present names block in the given forms: form, _number.

    ``<stem>_<n><suffix>`` blocks number n of ``<stem>`` and ``<suffix>`` and, where the
    whole name ends in ``_<n>``, of the rest without a suffix.
    """
    split = r"(?s)^(.+)_([1-9]\d{0,17})\z"

    def blocked(numbered, ending) -> DataFrame:
        return names.select(
            "folder",
            F.regexp_extract(numbered, split, 1).alias("head"),
            ending.alias("tail"),
            F.regexp_extract(numbered, split, 2).try_cast("long").alias("_number"),
        ).where("_number is not null")

    name = F.col("name")
    found = blocked(stem(name), suffix(name)).unionByName(blocked(name, F.lit("")))
    return found.join(small_side(forms.select(*_FORM)), _FORM, "left_semi").distinct()


def _free_numbers(items: DataFrame, numbers_taken: DataFrame, forms: DataFrame) -> DataFrame:
    """The items (form, item) with ``_number``: in order, the first numbers that are not taken.

    The i-th taken number t of a form has t - i free ones below it, so item s goes behind all
    taken numbers with fewer than s free ones below. With both in one row in this order, the place of
    an item in the row is its number: no number is looked at that is neither taken nor given.
    """
    counts = numbers_taken.groupBy(*_FORM).agg(F.count(F.lit(1)).alias("_taken"))
    sizes = forms.join(counts, _FORM, "left").select(F.col("_items") + F.coalesce("_taken", F.lit(0)))
    largest = sizes.agg(F.max(sizes.columns[0])).first()[0]
    placed = rank_within(items, _FORM, [F.col("item")], "_slot", largest)
    ranked = rank_within(numbers_taken, _FORM, [F.col("_number")], "_rank", largest)
    row = placed.select(*_FORM, (F.col("_slot") - 1).alias("_free"), "item", F.lit(True).alias("_given")).unionByName(
        ranked.select(*_FORM, (F.col("_number") - F.col("_rank")).alias("_free"), F.lit(None).cast(items.schema["item"].dataType).alias("item"), F.lit(False).alias("_given"))
    )
    return rank_within(row, _FORM, [F.col("_free"), F.col("_given"), F.col("item")], "_number", largest).where("_given")


def assign_years(
    inventory: DataFrame, base_dir: str, combined: str, years=COMBINED_YEARS, strict: bool = False
) -> DataFrame:
    """What of a combined release moves where, before names are made unique.

    `inventory` is (path, is_dir) of everything below `base_dir`. Items without a
    year stay and are left out. Adds ``root``, the path of the file or folder that is
    moved (the topmost folder with a year takes its whole content along), ``inner``,
    the rest of the path below that root, and ``period``.
    """
    home = f"{base_dir.rstrip('/')}/{combined}/"
    below = inventory.where(F.startswith(F.col("path"), F.lit(home)))
    year = year_in_name("n", years, strict)
    folders = "if(is_dir, names, slice(names, 1, size(names) - 1))"
    dated = f"filter(transform({folders}, (n, i) -> named_struct('depth', i + 1, 'year', {year})), f -> f.year IS NOT NULL)"
    own = f"filter(transform(slice(names, -1, 1), n -> named_struct('depth', size(names), 'year', {year})), f -> f.year IS NOT NULL)"
    move = (
        f"named_struct('root', concat({quoted(home)}, array_join(slice(names, 1, f.depth), '/')), "
        "'inner', array_join(slice(names, f.depth + 1, size(names)), '/'), 'period', cast(f.year AS STRING))"
    )
    # At most one move per item, unfolded so that the names are looked at once.
    moves = let(
        "names",
        f"split(substring(path, {len(home) + 1}), '/')",
        let("d", dated, f"transform(if(size(d) > 0 OR is_dir, slice(d, 1, 1), {own}), f -> {move})"),
    )
    return below.select("path", "is_dir", F.explode(F.expr(moves)).alias("_move")).select("path", "is_dir", "_move.*")


def reassign_periods(
    inventory: DataFrame, base_dir: str, combined: str = "1996", years=COMBINED_YEARS, strict: bool = False
) -> DataFrame:
    """Move list of a combined release: old_path, new_path, period, is_dir, is_root.

    Rows with ``is_root`` are the moves to make; the others follow along with their
    folder. An item already in place is not listed. The list keyed by `old_path`
    re-points the ledger (see `moves_for_ledger`). Paths of the inventory and `base_dir` may
    have any form that `normal_path` knows; what comes out is normal.
    """
    base = normal_folder(inventory.sparkSession, base_dir)
    inventory = inventory.withColumn("path", normal_path(F.col("path")))
    homes = "|".join(str(y) for y in years)
    in_home = F.col("path").rlike(rf"(?s)\A{re.escape(base)}/(?:{homes})/[^/]+\z")
    # One pass over the inventory keeps both kinds of rows: what moves, and what lies in the targets.
    inside = F.startswith(F.col("path"), F.lit(f"{base}/{combined}/"))
    stored = materialise(inventory.where(inside | in_home))
    assigned = assign_years(stored, base, combined, years, strict)
    target = F.concat_ws("/", F.lit(base), "period")
    assigned = materialise(
        assigned.withColumns({"folder": target, "name": base_name(F.col("root"))}).where(
            F.concat_ws("/", "folder", "name") != F.col("root")
        )
    )
    roots = assigned.where("path = root").select("folder", "name", "is_dir", F.col("root").alias("item"))
    present = stored.where(in_home).select(
        F.regexp_extract("path", r"(?s)^(.*)/", 1).alias("folder"), base_name(F.col("path")).alias("name")
    )
    named = free_names(roots, present).select(F.col("item").alias("root"), "new_name")
    moved = assigned.join(named, "root")
    return moved.select(
        F.col("path").alias("old_path"),
        F.concat_ws("/", "folder", "new_name", F.nullif("inner", F.lit(""))).alias("new_path"),
        "period",
        "is_dir",
        (F.col("path") == F.col("root")).alias("is_root"),
    )


def moves_for_ledger(manifest: DataFrame, moves: DataFrame) -> DataFrame:
    """Keys whose saved path moved, for `repoint`: period, url, new_path."""
    paths = moves.select(normal_path(F.col("old_path")).alias("saved_path"), "new_path")
    saved = manifest.select("period", "url", normal_path(F.col("saved_path")).alias("saved_path"))
    return skew_join(saved, paths, ["saved_path"], "inner").select(
        "period", "url", "new_path"
    )
