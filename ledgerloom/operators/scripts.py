"""Script files: blocks, hashes, order, drift, template rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import scripts as S
from ledgerloom.operators.ids import ordered_rank
from ledgerloom.operators.joins import lookup

PATH = ["release_version", "target_group_alias", "filename"]


def script_blocks(
    files: DataFrame, text: str = "content", delimiter: str = S.BLOCK_DELIMITER
) -> DataFrame:
    """One row per executable block, numbered from 1 inside its file, comments removed."""
    blocks = S.split_blocks(F.col(text), delimiter, comments=False)
    others = [c for c in files.columns if c != text]
    return files.select(*others, F.posexplode(blocks).alias("_pos", "block")).select(
        *others, (F.col("_pos") + 1).alias("block_no"), F.col("block")
    )


def block_counts(
    files: DataFrame, text: str = "content", delimiter: str = S.BLOCK_DELIMITER
) -> DataFrame:
    """Files with their number of blocks; no row per block is made."""
    blocks = F.size(S.split_blocks(F.col(text), delimiter, comments=False))
    return files.select(*[c for c in files.columns if c != text], blocks.alias("blocks_total"))


def script_hashes(files: DataFrame, tag: str, text: str = "content") -> DataFrame:
    """Hash of the whole file, of its settings section (null without one), and of the rest."""
    content = F.col(text)
    return files.select(
        *[c for c in files.columns if c != text],
        S.content_hash(content).alias("file_hash"),
        S.content_hash(S.settings_section(content, tag)).alias("config_hash"),
        S.content_hash(S.without_settings(content, tag)).alias("blocks_hash"),
    )


def script_progress(files: DataFrame, migrated: Column, text: str = "content") -> DataFrame:
    """What a ledger keeps of files that were run up to a block, to go on from there later.

    Adds ``blocks_migrated``, ``blocks_total``, ``migrated_hash`` (of the blocks that were run) and
    ``blocks_hash`` (of all blocks). A file has run at least none and at most all of its blocks.
    """
    others = [c for c in files.columns if c != text]
    split = files.select(*others, migrated.alias("_asked"), S.split_blocks(F.col(text), comments=False).alias("_blocks"))
    total = F.size("_blocks")
    done = split.select(
        *others, "_blocks", total.alias("blocks_total"), F.greatest(F.lit(0), F.least(F.col("_asked"), total)).alias("blocks_migrated")
    )
    return done.select(
        *others,
        "blocks_migrated",
        "blocks_total",
        S.chain_hash(F.col("_blocks"), F.col("blocks_migrated")).alias("migrated_hash"),
        S.chain_hash(F.col("_blocks")).alias("blocks_hash"),
    )


def resume_points(
    progress: DataFrame, current: DataFrame, path: list[str] = PATH, text: str = "content"
) -> DataFrame:
    """Where each file goes on: the first block to run and how many there are.

    ``progress`` comes from ``script_progress``; a path occurs once on each side. A file is

    - ``Added`` (all its blocks are to run) or ``Removed``,
    - ``Unchanged``: it goes on behind the blocks that were run,
    - ``Rest changed``: the blocks that were run are the same, so it goes on behind them as well,
    - ``Prefix changed``: a block that was run is another one or gone. Nothing of it is to run: what
      it did would have to be taken back first.

    Texts are cut into blocks where they lie, and only hashes are joined.
    """
    known = progress.select(*path, "blocks_migrated", "migrated_hash", "blocks_hash", F.lit(True).alias("_known"))
    blocks = S.split_blocks(F.col(text), comments=False)
    # The hash of the migrated blocks needs their number, which is in the ledger: a hash per prefix is kept.
    here = current.select(*path, blocks.alias("_blocks")).select(
        *path,
        F.size("_blocks").alias("blocks_total"),
        S.chain_hash(F.col("_blocks")).alias("_hash"),
        S.chain_hashes(F.col("_blocks")).alias("_prefixes"),
    )
    both = known.join(here, path, "full")
    prefix = F.get("_prefixes", F.col("blocks_migrated"))
    status = (
        F.when(F.col("_known").isNull(), "Added")
        .when(F.col("blocks_total").isNull(), "Removed")
        .when(F.col("_hash") == F.col("blocks_hash"), "Unchanged")
        .when(prefix.eqNullSafe(F.col("migrated_hash")), "Rest changed")
        .otherwise("Prefix changed")
    )
    before = F.coalesce("blocks_migrated", F.lit(0))
    goes_on = F.col("status").isin("Added", "Unchanged", "Rest changed") & (F.col("blocks_total") > before)
    return both.withColumn("status", status).select(
        *path,
        "status",
        "blocks_migrated",
        "blocks_total",
        F.when(goes_on, before + 1).alias("first_block"),
        F.when(goes_on, F.col("blocks_total") - before).otherwise(0).alias("blocks_to_run"),
    )


def file_order(files: DataFrame, path: list[str] = PATH) -> DataFrame:
    """Position of each distinct path in the order of its parts."""
    return ordered_rank(files.select(*path).distinct(), path, "file_order_id")


def script_drift(
    previous: DataFrame, current: DataFrame, path: list[str] = PATH, hash_col: str = "file_hash"
) -> DataFrame:
    """Each path as Added, Removed, Changed or Unchanged. A path occurs once per inventory.

    One aggregation over both inventories instead of a full outer join, which cannot be split
    when a key is hot; equal paths combine on the map side.
    """

    def side(inventory: DataFrame, name: str) -> DataFrame:
        return inventory.select(*path, F.lit(name).alias("_side"), F.col(hash_col).alias("_hash"))

    def at(name: str) -> tuple[Column, Column]:
        here = F.col("_side") == name
        return F.max(here).alias(f"_in_{name}"), F.max(F.when(here, F.col("_hash"))).alias(f"{name}_hash")

    both = side(previous, "previous").unionByName(side(current, "current"))
    merged = both.groupBy(*path).agg(*at("previous"), *at("current"))
    status = (
        F.when(~F.col("_in_previous"), "Added")
        .when(~F.col("_in_current"), "Removed")
        .when(F.col("previous_hash").eqNullSafe(F.col("current_hash")), "Unchanged")
        .otherwise("Changed")
    )
    return merged.select(*path, "previous_hash", "current_hash", status.alias("drift"))


def render_templates(
    templates: DataFrame, config: DataFrame, on: list[str], keys: dict[str, str], text: str = "content"
) -> DataFrame:
    """Fill the placeholders of each template from its row of ``config``.

    ``keys`` maps a placeholder key to a column of ``config``. Adds ``rendered`` and
    ``unresolved``, the keys without a value, joined by commas. Of several rows of ``config`` for
    one template the smallest counts.
    """
    first = F.min(F.struct(*keys.values())).alias("_config")
    rows = lookup(templates, config.groupBy(*on).agg(first), on)
    values = F.create_map(
        *[x for key, column in keys.items() for x in (F.lit(key), F.col("_config")[column])]
    )
    unknown = F.filter(
        S.placeholder_keys(F.col(text)), lambda key: F.try_element_at(values, key).isNull()
    )
    return rows.select(
        *[c for c in templates.columns if c != text],
        S.render(F.col(text), values).alias("rendered"),
        F.array_join(F.array_sort(unknown), ",").alias("unresolved"),
    )
