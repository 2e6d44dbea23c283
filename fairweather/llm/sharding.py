"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a row draws one child of its node: every child gets a hash of
key and child as a uniform number ``u``, and the smallest ``-ln(u) / weight``
wins. A child therefore wins in proportion to its weight, and a change of one
child's weight moves rows only into or out of that child. The weight of an
inner node is the sum of its leaves.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairweather.llm.ranking import PART, number_rows
from fairweather.session import Scratch

# region -> rack -> shard number -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

# The layout that `standard_tree` starts from.
REGIONS, RACKS, SHARDS_PER_RACK = 2, 2, 4


def standard_tree(n_shards: int) -> Tree:
    """A tree of ``n_shards`` shards of equal weight, decided by their number alone.

    The first sixteen shards fill two regions of two racks of four. Every
    further shard is a region of its own: then no other subtree's weight
    changes, and one more shard takes rows only into itself.
    """
    if n_shards < 1:
        raise ValueError("a tree needs at least one shard")
    base = REGIONS * RACKS * SHARDS_PER_RACK
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(n_shards):
        if shard < base:
            rack = shard // SHARDS_PER_RACK
            names = f"region{rack // RACKS}", f"rack{rack}"
        else:
            names = f"region{REGIONS + shard - base}", f"rack{REGIONS * RACKS + shard - base}"
        tree.setdefault(names[0], {}).setdefault(names[1], {})[shard] = 1.0
    return tree


def _weight(node: float | Mapping) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, Mapping) else float(node)


def _draw(key: Column, children: Mapping[str, float]) -> Column:
    """The child that wins the weighted draw; equal draws go to the smaller name."""
    if any(weight < 0 for weight in children.values()):
        raise ValueError("weights must not be negative")
    running = {name: weight for name, weight in children.items() if weight > 0}
    if len(running) == 1:
        return F.lit(next(iter(running)))

    def score(name: str, weight: float) -> Column:
        # 52 bits of the hash, moved off zero
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 12) + F.lit(0.5)) / F.lit(2.0**52)
        return F.struct((-F.log(u) / F.lit(weight)).alias("draw"), F.lit(name).alias("name"))

    return F.array_min(F.array(*[score(n, w) for n, w in running.items()]))["name"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key: one draw per level, along the path that was drawn."""
    regions = {region: racks for region, racks in tree.items() if _weight(racks) > 0}
    if not regions:
        raise ValueError("the tree has no shard with a weight")
    region = _draw(key, {name: _weight(racks) for name, racks in regions.items()})

    def choose(drawn: Column, below: dict[str, Column]) -> Column:
        chosen = F.lit(None)
        for name, column in below.items():
            chosen = F.when(drawn == name, column).otherwise(chosen)
        return chosen

    in_region = {}
    for name, racks in regions.items():
        live = {rack: shards for rack, shards in racks.items() if _weight(shards) > 0}
        rack = _draw(key, {f"{name}/{r}": _weight(shards) for r, shards in live.items()})
        in_region[name] = choose(
            rack,
            {
                f"{name}/{r}": _draw(key, {f"{name}/{r}/{n}": w for n, w in shards.items()})
                for r, shards in live.items()
            },
        )
    return F.element_at(F.split(choose(region, in_region), "/"), -1).cast("int")


def shard_rows(rows: DataFrame, key: str, tree: Tree, scratch: Scratch) -> DataFrame:
    """Rows with ``shard`` and a gapless ``slot`` within it.

    The key alone decides the shard; a null key is a key like any other, and
    rows that repeat a key share its shard. Slots follow the order of the key
    and the other columns within pieces that one task wrote. Select what you need before: all columns
    are written to the scratch folder once and shuffled once.
    """
    placed = rows.withColumns(
        {"shard": shard_of(F.col(key), tree), PART: F.spark_partition_id()}
    )
    order = [key, *[c for c in rows.columns if c != key]]
    return number_rows(scratch.materialize(placed, "placed"), ["shard"], order, "slot")
