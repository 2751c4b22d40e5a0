"""Families: declared groups of assets, merged where members of different groups correlate, thinned by the same-item test, with weights.

The steps are those of the library: declared keys, ``dedup.correlated_pairs``, components over the groups' keys (so a group of
any size is one node), the greedy choice in each family, and weights by the number of rows that stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.components import connected_components
from tessera.operators.correlate import correlated_pairs
from tessera.operators.dedup import greedy_classes
from tessera.operators.reports import repeat_weight
from tessera.storage import materialize


def unique_labels(rows: DataFrame, name: str, bucket: str, label: str = "label") -> DataFrame:
    """``rows`` with ``label``: the name, with its bucket before it where rows of several places share the name."""
    n = max(rows.columns, key=len) + "_n"  # no other column has this name
    often = rows.groupBy(name).agg(F.count("*").alias(n)).where(F.col(n) > 1)
    many = rows.join(often, name, "left")
    return many.withColumn(label, F.when(F.col(n).isNotNull(), F.concat_ws("/", bucket, name)).otherwise(F.col(name))).select(*[c for c in rows.columns if c != label], label)


def declared_key(label: Column, source: Column, post: Column, root: Column | None = None, trees: tuple[str, ...] = (), tree_prefix: str = "tree", other: str = "post") -> Column:
    """``single:<label>`` without a post, ``<tree_prefix>:<root>`` for a source whose name starts as one of ``trees``, else ``<source>:<post>``.

    ``root`` is the first post of a chain of parents, a post without one is its own. A missing source reads ``other``.
    """
    src = F.lower(F.coalesce(source, F.lit("")))
    tree = F.lit(False)
    for t in trees:
        tree = tree | src.startswith(t)
    top = F.coalesce(root, post) if root is not None else post
    single = F.concat(F.lit("single:"), label.cast("string"))
    return F.when(post.isNull(), single).when(tree, F.concat_ws(":", F.lit(tree_prefix), top.cast("string"))).otherwise(F.concat_ws(":", F.coalesce(F.nullif(src, F.lit("")), F.lit(other)), post.cast("string")))


def family_plan(rows: DataFrame, key: str, declared: str, vector: str, pixels: str, order: str, near: Callable[[DataFrame], DataFrame], least: float, scale: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(plans, members, merges)`` of ``rows`` with a long ``key`` of one row each and a ``declared`` group that is not null.

    Groups are one family where vectors of two of them correlate by ``least`` or more. In a family, rows go by ``order``
    descending, and one near (``near(reps)`` gives pairs of the rows it is given) a row that stays is dropped for it.
    ``plans(family, n_declared, n_members, kept, bucket, repeats)``: a family is named after its least group, with ``+n`` for n more,
    and gets ``diff<kept>`` and the weight of that size. ``members(key, declared, family, of)``: ``of`` is null for rows that stay.
    ``merges(family, a, b, corr)``: the pairs that joined groups. Rows without a vector are families by their group alone.
    """
    base, root = rows, max(rows.columns, key=len) + "_root"  # no other column has this name
    pairs = materialize(correlated_pairs(base.where(F.col(vector).isNotNull()), key, vector, declared, least), "family-pairs")
    side = lambda k, d: base.select(F.col(key).alias(k), F.col(declared).alias(d))
    joined = materialize(pairs.join(side("a", "da"), "a").join(side("b", "db"), "b"), "family-pairs")
    roots = materialize(connected_components(joined, "da", "db"), "families")
    owned = base.join(roots, base[declared] == roots.node, "left").select(*[base[c] for c in base.columns], F.coalesce(roots.component, base[declared]).alias(root))
    owned = materialize(owned, "family-rows")
    gone = greedy_classes(owned.where(F.col(pixels).isNotNull()), root, key, order, pixels, near)
    groups = owned.groupBy(F.col(root).alias("root"), F.col(declared).alias("declared")).agg(F.count("*").alias("n")).groupBy("root").agg(F.count("*").alias("n_declared"), F.sum("n").alias("n_members"))
    named = materialize(groups.withColumn("family", F.when(F.col("n_declared") > 1, F.concat("root", F.lit("+"), (F.col("n_declared") - 1).cast("string"))).otherwise(F.col("root"))), "family-names")
    of = owned.select(F.col(key).alias("dropped"), F.col(declared).alias("declared"), F.col(root).alias("root")).join(gone, "dropped", "left")
    members = materialize(of.join(named.select("root", "family"), "root").select(F.col("dropped").alias(key), F.col("declared").alias(declared), "family", "of"), "family-members")
    kept = members.where("of IS NULL").groupBy("family").agg(F.count("*").alias("kept"))
    # the best row of a family always stays
    plans = named.join(kept, "family").select("family", "n_declared", "n_members", "kept", F.concat(F.lit("diff"), F.col("kept").cast("string")).alias("bucket"), repeat_weight(F.col("kept"), scale).alias("repeats"))
    merges = joined.join(roots, joined.da == roots.node).join(named, F.col("component") == F.col("root")).select("family", "a", "b", "corr")
    return plans, members, merges
