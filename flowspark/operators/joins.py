"""The join shapes the operators share, each as a hash join that survives hot keys.

* `candidate_join`: "either end is listed", an OR of two equalities.
* `id_join`: left join on an id, with null ids spread over all partitions.
* `both_ends_join`: two of these to one table, rows with one id being shuffled once.
* `lifetime_join`: left join on IP address and time, an address meeting one row.
* `both_lifetimes_join`: two of these to one table, of distinct rows, those with one held address being shuffled once.
* `merge_lifetimes`, `next_start`: the same care for the entity side.

Hot non-null ids and addresses are split by adaptive execution, which can do so
because all of these are plain equi-joins (left outer joins split their left side).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions import apart, hour_start, in_window, minute_index

BROADCAST_LIMIT_BYTES = 32 << 20
NULL_KEY_SPREAD = 4096
# Lifetimes of one address that are packed together, in bytes, and how many parts a table may have beyond that.
PART_BYTES = 64 << 10
MOST_PARTS = 100_000
# Networks that are broadcast to tell which addresses may be held.
NETWORKS_BYTES = 8 << 20


def _text_bytes(df: DataFrame) -> Column:
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns]
    return reduce(lambda a, b: a + b, sizes).cast("bigint")


class Size(NamedTuple):
    """Bytes of a table, and of the rows under its most frequent address."""

    total: int
    largest: int


def is_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether a table is small enough to broadcast, by measuring it.

    That is one distributed pass, so hand the operators that ask for it base tables or
    kept views (`sources.cut_lineage`), not long derivations.
    """
    return df.agg(F.coalesce(F.sum(_text_bytes(df)), F.lit(0))).first()[0] <= limit_bytes


def size_by(df: DataFrame, ip: str) -> Size:
    """How large a table is, and how much of it one address has; absent ones have nothing."""
    of_address = df.groupBy(F.col(ip).alias("_ip")).agg(F.sum(_text_bytes(df)).alias("_bytes"))
    largest = F.max(F.when(F.col("_ip").isNotNull(), F.col("_bytes")))
    return Size(*of_address.agg(F.coalesce(F.sum("_bytes"), F.lit(0)), F.coalesce(largest, F.lit(0))).first())


def candidate_join(
    flows: DataFrame,
    listed: DataFrame,
    listed_key: str,
    src: str,
    dst: str,
    src_counts: Column | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Inner join of flows to a list on "the source is listed and `src_counts`, or the destination is".

    Each flow offers its one or two distinct candidate addresses, so a flow and
    a list entry meet at most once, as under the OR; the join itself is a hash
    join on the address. A null `src_counts` is no match, as in SQL.
    """
    source = F.col(src) if src_counts is None else F.when(src_counts, F.col(src))
    candidates = F.array_distinct(F.array_compact(F.array(source, F.col(dst))))
    if is_small(listed, broadcast_limit):
        listed = F.broadcast(listed)
    return (
        flows.withColumn("_candidate", F.explode(candidates))
        .join(listed, F.col("_candidate") == F.col(listed_key))
        .drop("_candidate")
    )


def with_listed_end(
    flows: DataFrame,
    listed: DataFrame,
    listed_key: str,
    src: str,
    dst: str,
    spread_by: list[str],
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """The flows, each as often as it occurs, one of whose ends is listed.

    It needs nothing but the addresses, so it stands below enrichment: what is not listed is neither made distinct nor joined
    to entities. `candidate_join` above then applies the exact condition.
    """
    values = listed.select(F.col(listed_key).alias("_listed")).where("_listed is not null").distinct()
    small = is_small(values, broadcast_limit)
    for end in (src, dst):
        marked = values.select(F.col("_listed").alias(f"_listed_{end}"))
        flows = id_join(flows, marked, end, f"_listed_{end}", spread_by, small)
    found = F.col(f"_listed_{src}").isNotNull() | F.col(f"_listed_{dst}").isNotNull()
    return flows.where(found).drop(f"_listed_{src}", f"_listed_{dst}")


def _spread(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(NULL_KEY_SPREAD))


def id_join(
    left: DataFrame,
    right: DataFrame,
    left_id: str | Column,
    right_id: str,
    spread_by: list[str],
    small: bool = False,
) -> DataFrame:
    """Left outer join on `left_id = right_id`; `small` tells that `right` was measured to be so.

    Beyond a broadcast, rows without an id match nothing, but a shuffle would send them all to one
    task; they get a made-up id from `spread_by` instead, and a condition that
    keeps it from ever matching.
    """
    own_id = F.col(left_id) if isinstance(left_id, str) else left_id
    if small:
        return left.join(F.broadcast(right), own_id == F.col(right_id), "left")
    made_up = F.concat(F.lit("\u0000"), _spread(spread_by).cast("string"))
    # An expression, not a column, so that it does not travel beside the id.
    spread_id = F.coalesce(own_id, made_up)
    return left.join(right, (spread_id == F.col(right_id)) & own_id.isNotNull(), "left")


def both_ends_join(
    left: DataFrame,
    right: DataFrame,
    ends: dict[str, str],
    right_id: str,
    spread_by: list[str],
    small: bool = False,
) -> DataFrame:
    """Two `id_join`s of rows with two ends to one table: its other columns for each end, under that end's prefix.

    `ends` tells the column of ids by prefix. Beyond a broadcast, rows are shuffled by the first id they have, and only those
    with both once more, by the second. Rows with both and rows with one are told apart behind a generator, which
    filters are not copied through, so that the branches have one shuffle below them, and rows are made once.
    """
    (first, first_id), (second, second_id) = ends.items()
    carried = [c for c in right.columns if c != right_id]

    def of(prefix: str) -> DataFrame:
        return right.select(F.col(right_id).alias(f"_{prefix}id"), *[F.col(c).alias(f"{prefix}{c}") for c in carried])

    if small:
        joined = id_join(left, of(first), first_id, f"_{first}id", spread_by, small)
        return id_join(joined, of(second), second_id, f"_{second}id", spread_by, small).drop(f"_{first}id", f"_{second}id")
    met = id_join(left, of("_met_"), F.coalesce(first_id, second_id), "__met_id", spread_by).drop("__met_id")
    has_first, has_both = F.col(first_id).isNotNull(), F.col(first_id).isNotNull() & F.col(second_id).isNotNull()
    met = apart(met.withColumn("_both", has_both), "_both")
    rows = [F.col(f"`{c}`") for c in left.columns]
    one = met.where("not _both").select(
        *rows,
        *[F.when(has_first, F.col(f"_met_{c}")).alias(f"{first}{c}") for c in carried],
        *[F.when(~has_first, F.col(f"_met_{c}")).alias(f"{second}{c}") for c in carried],
    )
    both = met.where("_both").select(*rows, *[F.col(f"_met_{c}").alias(f"{first}{c}") for c in carried])
    return one.unionByName(id_join(both, of(second), second_id, f"_{second}id", spread_by).drop(f"_{second}id"))


def _leading(size: Column, holds: Callable[[Column], Column]) -> Column:
    """How many first places 0, 1, .. below `size` hold, by binary search: those that do come before those that don't."""
    steps = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(size + 1)).cast("int"), F.lit(1)))
    zero = F.lit(0)

    def halved(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high) / 2).cast("int")
        below = F.struct((middle + 1).alias("low"), high.alias("high"))
        above = F.struct(low.alias("low"), middle.alias("high"))
        return F.when(low >= high, state).when(holds(middle), below).otherwise(above)

    start = F.struct(zero.alias("low"), size.cast("int").alias("high"))
    return F.aggregate(steps, start, halved, lambda state: state["low"])


def _part_of(edges: Column, ts: Column) -> Column:
    """Which of an address's parts a time lies in: 0 before the first edge and where there are none."""
    passed = _leading(F.size(edges), lambda place: F.get(edges, place) <= minute_index(ts))
    return F.when(edges.isNull(), 0).otherwise(passed)


def _edges(alive: DataFrame, ip: str, start: str, part_bytes: int) -> DataFrame:
    """Addresses whose lifetimes take more than `part_bytes`, with the minutes at which their parts but the first begin.

    Lifetimes are summed by minute of their start, so the window has a row a minute.
    """
    minutes = alive.groupBy(F.col(ip).alias("_ip"), minute_index(F.col(start)).alias("_minute")).agg(
        F.sum(_text_bytes(alive)).alias("_bytes")
    )
    before = Window.partitionBy("_ip").orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        minutes.withColumn("_number", F.floor(F.coalesce(F.sum("_bytes").over(before), F.lit(0)) / part_bytes))
        .groupBy("_ip", "_number")
        .agg(F.min("_minute").alias("_edge"))
        .where("_number > 0")
    )
    return parts.groupBy("_ip").agg(F.sort_array(F.collect_list("_edge")).alias("_edges"))


def _packed(alive: DataFrame, edges: DataFrame | None, ip: str, start: str, end: str) -> DataFrame:
    """One row per address and part: its lifetimes in order of their start, each with the latest end up to it (`reach`)."""
    far = F.lit("9999-12-31 00:00:00").cast("timestamp")
    if edges is None:
        dealt = alive.withColumn("_part", F.lit(0))
    else:
        bounded = alive.join(F.broadcast(edges), F.col(ip) == F.col("_ip"), "left")
        first, last = (_part_of(F.col("_edges"), F.col(c)) for c in (start, end))
        last = F.when(F.col(end).isNull(), F.size("_edges")).otherwise(last)
        parts = F.when(F.col("_edges").isNull(), F.array(F.lit(0))).otherwise(F.sequence(first, last))
        dealt = bounded.withColumn("_part", F.explode(parts))
    # Lifetimes that start together have one reach, whatever their order.
    until = F.max(F.coalesce(F.col(end), far)).over(Window.partitionBy(ip, "_part").orderBy(start))
    life = F.struct(F.col(start).alias("since"), F.col("_reach").alias("reach"), F.col(end).alias("until"), F.struct(*alive.columns).alias("row"))
    by_start = lambda a, b: F.when(a["since"] < b["since"], -1).when(a["since"] > b["since"], 1).otherwise(0)
    packed = dealt.withColumn("_reach", until).groupBy(F.col(ip).alias("_held_ip"), F.col("_part").alias("_held_part"))
    return packed.agg(F.array_sort(F.collect_list(life), by_start).alias("_lives"))


class _Row:
    """Columns of a joined row by name, as of a struct."""

    def __getitem__(self, name: str) -> Column:
        return F.col(name)


def lifetime_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_ip: str,
    left_time: str,
    right_ip: str,
    right_start: str,
    right_end: str,
    spread_by: list[str],
    size: Size,
    condition: Callable[[Column], Column] | None = None,
    open_end: bool = True,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Left outer join of rows to the entities that held their IP address at their time.

    `size` is what `size_by` measured of `right`. If it is small (`broadcast_limit`) and no address has more than `part_bytes`
    of it, it is broadcast as it is, and a row meets the few holders of its address.

    Else `right` is packed: one row per address with its lifetimes in order of their start, in which a row finds those that its time
    lies in by two binary searches. So a row meets one other, however often its address was passed on, and no entity is
    repeated for the time it lived. Only an address whose lifetimes take more than `part_bytes` is cut into parts in time; an
    entity that lives across an edge is in the parts on both sides. Where parts begin is broadcast: parts are made large
    enough for the size of the table that there are at most 2 * `MOST_PARTS` of them.

    A small packed table is broadcast, else both sides are shuffled by (address, part). A busy
    address is then split by adaptive execution. `condition` gets the matched entity as a struct and tells whether it
    counts. Column names of both sides must differ.
    """
    ip, ts = F.col(left_ip), F.col(left_time)
    start, end = F.col(right_start), F.col(right_end)
    small = size.total <= broadcast_limit
    if small and size.largest <= part_bytes:
        match = (ip == F.col(right_ip)) & in_window(ts, start, end, open_end)
        if condition is not None:
            match &= condition(_Row())
        return left.join(F.broadcast(right), match, "left")
    can_match = F.col(right_ip).isNotNull() & start.isNotNull()
    can_match &= (end.isNull() | (end >= start)) if open_end else (end >= start)
    alive = right.where(can_match)
    edges = None
    if size.largest > part_bytes:
        edges = _edges(alive, right_ip, right_start, max(part_bytes, size.total // MOST_PARTS))
    packed = _packed(alive, edges, right_ip, right_start, right_end)
    # Else adaptive execution, which knows the size of the shuffled rows but not that of what is packed above its shuffle, builds
    # hash maps of the rows, up to 64 MB compressed a task, several times that in memory, and they cannot spill.
    packed = F.broadcast(packed) if small else packed.hint("merge")

    def holds(life: Column) -> Column:
        within = in_window(ts, life["since"], life["until"], open_end)
        return within if condition is None else within & condition(life["row"])

    keyed = _keyed(left, edges, ip, ts, spread_by)
    found = keyed.join(packed, _same(edges) & ip.isNotNull() & ts.isNotNull(), "left")
    columns = [F.col(f"`{c}`") for c in left.columns]
    matched = found.select(*columns, F.explode_outer(F.filter(_searched(ts), holds)).alias("_life"))
    return matched.select(*columns, "_life.row.*")


def _keyed(rows: DataFrame, edges: DataFrame | None, ip: Column, ts: Column, spread_by: list[str]) -> DataFrame:
    """Rows with the address (`_key`) and, where some are cut, the part (`_part`) that they meet lifetimes under.

    What can't match is dealt out, under made-up addresses. Numbers of parts alone don't do for that: where all
    are 0, the optimizer takes them out of the keys, and the rows without an address would meet in one task.
    """
    lost = ip.isNull() | ts.isNull()
    made_up = F.concat(F.lit("\u0000"), _spread(spread_by).cast("string"))
    keyed = rows.withColumn("_key", F.when(lost, made_up).otherwise(ip))
    if edges is None:
        return keyed
    part = _part_of(F.col("_edges"), ts).cast("int")
    return keyed.join(F.broadcast(edges), F.col("_key") == F.col("_ip"), "left").withColumn("_part", part).drop("_ip", "_edges")


def _same(edges: DataFrame | None) -> Column:
    same = F.col("_key") == F.col("_held_ip")
    return same if edges is None else same & (F.col("_part") == F.col("_held_part"))


def _searched(ts: Column) -> Column:
    """The lifetimes of a packed row that a time may lie in: those that began by then, from the first that reaches it."""
    lives = F.col("_lives")
    begun = _leading(F.size(lives), lambda place: F.get(lives, place)["since"] <= ts)
    over = _leading(F.size(lives), lambda place: F.get(lives, place)["reach"] < ts)
    return F.when(F.size(lives) <= 8, lives).otherwise(F.slice(lives, over + 1, F.greatest(begun - over, F.lit(0))))


def _network(ip: Column) -> Column:
    """The first three numbers of an IPv4 address, any other address as it is."""
    return F.substring_index(ip, ".", 3)


def networks_of(entities: DataFrame, ip: str) -> DataFrame | None:
    """The networks that hold all addresses of entities, to be broadcast; none where they were measured to be too many for that."""
    networks = entities.select(_network(F.col(ip)).alias("_network")).where("_network is not null").distinct()
    return networks if is_small(networks, NETWORKS_BYTES) else None


def with_held(rows: DataFrame, networks: DataFrame | None, ip: str, name: str) -> DataFrame:
    """Rows marked by whether anybody may hold their address: somebody holds one of its network."""
    if networks is None:
        return rows.withColumn(name, F.col(ip).isNotNull())
    marked = rows.join(F.broadcast(networks), _network(F.col(ip)) == F.col("_network"), "left")
    return marked.withColumn(name, F.col("_network").isNotNull()).drop("_network")


def both_lifetimes_join(
    left: DataFrame,
    right: DataFrame,
    *,
    ends: dict[str, str],
    left_time: str,
    right_ip: str,
    right_start: str,
    right_end: str,
    identity: str,
    condition: Callable[[Column], Column],
    spread_by: list[str],
    size: Size,
    distinct: bool,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Distinct rows, with the entities that held the address of either end at their time, as two `lifetime_join`s beyond a broadcast.

    `ends` tells the columns of addresses by the prefix under which the columns of `right` come; `condition` is what else must hold of an
    entity at the first end. An end meets what is equal in `identity` once. `distinct` tells that rows are distinct as they come.

    Rows are shuffled by the first of their addresses that anybody may hold. Equal rows meet there, so repeats go in the sort that
    the join needs anyway. Only rows with two such addresses are shuffled again, by the second. Rows with one and rows with
    two are told apart behind a generator, which filters are not copied through, so that the branches have one shuffle below
    them, and rows are made once.
    """
    (first, first_ip), (second, second_ip) = ends.items()
    rows = [F.col(f"`{c}`") for c in left.columns]
    ts, start, end = F.col(left_time), F.col(right_start), F.col(right_end)
    alive = right.where(F.col(right_ip).isNotNull() & start.isNotNull() & (end.isNull() | (end >= start)))
    edges = None
    if size.largest > part_bytes:
        edges = _edges(alive, right_ip, right_start, max(part_bytes, size.total // MOST_PARTS))
    packed = _packed(alive, edges, right_ip, right_start, right_end).hint("merge")
    networks = networks_of(alive, right_ip)
    marked = with_held(with_held(left, networks, first_ip, "_first"), networks, second_ip, "_second")
    at_first, at_second = F.col("_first"), F.col("_second")
    address = F.when(at_first, F.col(first_ip)).when(at_second, F.col(second_ip))
    keys = ["_key"] if edges is None else ["_key", "_part"]
    dealt = _keyed(marked, edges, address, ts, spread_by).repartition(*keys)
    dealt = apart(dealt.withColumn("_both", at_first & at_second), "_both")

    def alone(some: DataFrame) -> DataFrame:
        if distinct:
            return some
        # By the keys first, so that the join needs no other sort.
        equal = Window.partitionBy(*keys, "_hash", *rows).orderBy("_hash")
        found = some.withColumn("_hash", F.xxhash64(*rows)).withColumn("_again", F.lag(F.lit(1)).over(equal))
        return found.where("_again is null").drop("_hash", "_again")

    def met(some: DataFrame, at_other: Column) -> DataFrame:
        """Rows that were dealt by an address, each with one entity that held it (`_life`); `at_other` tells rows that need no `condition`."""
        lives, found = F.col("_met"), some.join(packed, _same(edges) & ts.isNotNull(), "left")
        holds = lambda life: in_window(ts, life["since"], life["until"]) & (at_other | condition(life["row"]))
        again = lambda life, place: F.exists(
            F.slice(lives, F.lit(1), place), lambda other: other["row"][identity].eqNullSafe(life["row"][identity])
        )
        once = F.when(F.size(lives) <= 1, lives).otherwise(F.filter(lives, lambda life, place: ~again(life, place)))
        found = found.withColumn("_met", F.filter(_searched(ts), holds)).withColumn("_met", once)
        return found.select(*[F.col(f"`{c}`") for c in some.columns], F.explode_outer("_met").alias("_life"))

    def under(prefix: str, where: Column) -> list[Column]:
        return [F.when(where, F.col("_life")["row"][c]).alias(f"{prefix}_{c}") for c in right.columns]

    one = met(alone(dealt.where("not _both")), ~at_first).select(*rows, *under(first, at_first), *under(second, ~at_first))
    two = met(alone(dealt.where("_both")), F.lit(False)).select(*rows, *under(first, F.lit(True)))
    again = met(_keyed(two, edges, F.col(second_ip), ts, spread_by), F.lit(True))
    return one.unionByName(again.select(*rows, *[f"{first}_{c}" for c in right.columns], *under(second, F.lit(True))))


def merge_lifetimes(
    df: DataFrame, identity: list[str], start: str, end: str, carry: list[str] = ()
) -> DataFrame:
    """One row per maximal stretch of overlapping `[start, end]` of the same identity.

    After it, a time matches an identity at most once. `carry` columns are functions of the
    identity (such as a decoded map) and ride along. A null end is open.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp")
    bounds = [*identity, start, end]
    spans = df.groupBy(*bounds).agg(*[F.first(c).alias(c) for c in carry]) if carry else df.select(*bounds).distinct()
    until = F.coalesce(F.col(end), far)
    w = Window.partitionBy(*identity).orderBy(F.col(start), until)
    reach = F.max(until).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    stretch = F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        spans.where(F.col(start).isNotNull())
        .withColumn("_opens", opens)
        .withColumn("_stretch", stretch)
        .groupBy(*identity, "_stretch")
        .agg(
            F.min(start).alias(start),
            F.when(F.max(F.col(end).isNull()), None).otherwise(F.max(end)).alias(end),
            *[F.first(c).alias(c) for c in carry],
        )
    )
    return merged.drop("_stretch")


def next_start(
    df: DataFrame, key: str, order: str, ties: list[str], value: str, name: str
) -> DataFrame:
    """Add `name`: the `value` of the row after this one with the same key, by `order`.

    It is `lead(value) over (partition by key order by order, ties)` in two steps,
    so that one key may hold any share of the rows: a window inside each (key, hour), then one
    over the first and last row of each hour of a key. `ties` must tell rows apart.

    An absent key passes to nobody, and so does a row without a time, nor is it anyone's next: these rows
    get null and take no part in the windows, however many they are.
    """
    known = F.col(key).isNotNull() & F.col(order).isNotNull()
    sort = [F.col(c) for c in (order, *ties)]
    inside = Window.partitionBy(key, "_hour", "_apart").orderBy(*sort)
    # Rows that take no part are dealt out over groups of their own.
    dealt = F.pmod(F.xxhash64(*ties), F.lit(NULL_KEY_SPREAD))
    hourly = (
        df.withColumn("_hour", hour_start(F.col(order)))
        .withColumn("_apart", F.when(known, -1).otherwise(dealt))
        .withColumn("_inside", F.when(known, F.lead(F.struct(value)).over(inside)))
        .withColumn("_is_first", F.lag(F.lit(1)).over(inside).isNull())
    )
    # Rows inside an hour have their answer, and are dealt out as well.
    edge = known & (F.col("_is_first") | F.col("_inside").isNull())
    across = Window.partitionBy(key, "_group").orderBy(*sort)
    return (
        hourly.withColumn("_group", F.when(edge, -1).otherwise(dealt))
        .withColumn("_later", F.when(edge, F.lead(F.struct(value)).over(across)))
        .withColumn(name, F.coalesce("_inside", "_later")[value])
        .drop("_hour", "_apart", "_inside", "_is_first", "_group", "_later")
    )
