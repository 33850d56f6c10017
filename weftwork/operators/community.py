"""Communities by modularity, and their quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.operators.graph import connected_components
from weftwork.operators.ranking import position, running_total
from weftwork.session import materialise


def _with_weight(edges: DataFrame) -> DataFrame:
    weight = F.col("weight").cast("double") if "weight" in edges.columns else F.lit(1.0)
    return edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), weight.alias("w"))


def _strengths(edges: DataFrame) -> DataFrame:
    """(id, k): weighted degree, a self-loop counting twice."""
    return edges.select(F.explode(F.array("a", "b")).alias("id"), "w").groupBy("id").agg(F.sum("w").alias("k"))


def _quality(edges: DataFrame, member: DataFrame, resolution: float) -> DataFrame:
    """One row q = sum over communities of inside / m - resolution * (strength / 2m)^2."""
    member = materialise(member.select("id", "community"), "members")
    ca = member.select(F.col("id").alias("a"), F.col("community").alias("_ca"))
    cb = member.select(F.col("id").alias("b"), F.col("community").alias("_cb"))
    inside = edges.join(ca, "a").join(cb, "b").agg(
        F.sum(F.when(F.col("_ca") == F.col("_cb"), F.col("w")).otherwise(0.0)).alias("inside"),
        F.sum("w").alias("m"),
    )
    strength = _strengths(edges).join(member, "id").groupBy("community").agg(F.sum("k").alias("s"))
    squares = strength.agg(F.sum(F.col("s") * F.col("s"))).scalar()
    m = F.col("m")
    return inside.withColumn("_sq", squares).select(
        (F.try_divide("inside", m) - resolution * F.try_divide("_sq", 4 * m * m)).alias("q")
    )


def modularity(edges: DataFrame, member: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row (modularity) of a partition member(id, community)."""
    return _quality(_with_weight(edges), member.select("id", "community"), resolution).select(
        F.col("q").alias("modularity")
    )


def merge_round(edges: DataFrame, strengths: DataFrame, total: float, resolution: float = 1.0) -> DataFrame:
    """(id, to): communities that join a centre this round.

    edges(a, b, w) and strengths(id, k) are written tables over communities, total is the weight of all
    edges. The gain of a merge, times total, is w - resolution * k_a * k_b / (2 total), to 9 decimals;
    equal gains are told apart by the MD5 of "a|b", so that long chains pair up everywhere at once.
    Of two communities that are each other's best partner the stronger is a centre. All whose best
    partner it is may join it, best first, each if its gain stays positive with all before it in the
    centre. Links among those that join can only add to that, so the quality rises every round. The
    order of a centre's suitors is a running sum that is not confined to one task.
    """
    left = strengths.select(F.col("id").alias("a"), F.col("k").alias("ka"))
    right = strengths.select(F.col("id").alias("b"), F.col("k").alias("kb"))
    gain = F.round(F.col("w") - resolution * F.col("ka") * F.col("kb") / (2 * total), 9)
    tie = F.md5(F.concat_ws("|", F.col("a").cast("string"), F.col("b").cast("string")).cast("binary"))
    offers = edges.filter(F.col("a") != F.col("b")).join(left, "a").join(right, "b").select(
        gain.alias("gain"), tie.alias("tie"), "a", "b", "w", "ka", "kb"
    ).filter(F.col("gain") > 0)
    offer = F.struct("gain", "tie", "a", "b", "w", "ka", "kb")
    best = materialise(
        offers.select(F.explode(F.array("a", "b")).alias("id"), offer.alias("o")).groupBy("id").agg(F.max("o").alias("o")).select("id", "o.*"),
        "best",
    )
    first = F.col("ka") >= F.col("kb")
    centres = materialise(
        best.groupBy("a", "b", "ka", "kb").agg(F.count("*").alias("_n")).filter(F.col("_n") == 2).select(
            F.when(first, F.col("a")).otherwise(F.col("b")).alias("to"), F.greatest("ka", "kb").alias("kc")
        ),
        "centres",
    )
    mine = F.col("id") == F.col("a")
    suitors = best.select(
        "id", F.when(mine, F.col("b")).otherwise(F.col("a")).alias("to"), "gain", "tie", "w",
        F.when(mine, F.col("ka")).otherwise(F.col("kb")).alias("k"),
    ).join(centres, "to")
    order = [F.col("gain").desc(), F.col("tie").desc(), F.col("id").asc()]
    lined = running_total(suitors, ["to"], order, F.col("k"), "_upto")
    after = F.round(F.col("w") - resolution * F.col("k") * (F.col("kc") + (F.col("_upto") - F.col("k"))) / (2 * total), 9)
    return lined.filter(after > 0).select("id", "to")


def start_tables(edges: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """(edges(a, b, w), strengths(id, k), total): every vertex with an edge is a community."""
    summed = materialise(_with_weight(edges).groupBy("a", "b").agg(F.sum("w").alias("w")), "edges")
    return summed, materialise(_strengths(summed), "strengths"), summed.agg(F.sum("w")).first()[0] or 0.0


def communities(vertices: DataFrame, edges: DataFrame, resolution: float = 1.0) -> DataFrame:
    """(id, community): communities of high modularity, numbered by size from 0.

    Communities merge (see merge_round) until no merge raises the quality. Names are resolved from the last round back to the first.
    """
    level, strengths, total = start_tables(edges)
    names = merges_until_still(level, strengths, total, resolution)
    return numbered(materialise(
        vertices.select("id").join(names, "id", "left").select("id", F.coalesce("to", "id").alias("community")), "members"
    ))


def merges_until_still(level: DataFrame, strengths: DataFrame, total: float, resolution: float) -> DataFrame:
    """(id, to): where each community that merged ended, after rounds of merges until none raises the quality."""
    names = strengths.select("id", F.col("id").alias("to")).limit(0)
    rounds: list[DataFrame] = []
    while total:
        merges = materialise(merge_round(level, strengths, total, resolution), "merges")
        if merges.isEmpty():
            break
        rounds.append(merges)
        ends = level
        for side in ("a", "b"):
            named = merges.select(F.col("id").alias(side), F.col("to").alias(f"_{side}"))
            ends = ends.join(named, side, "left")
        ends = ends.select(F.coalesce("_a", "a").alias("_a"), F.coalesce("_b", "b").alias("_b"), "w")
        shorter = materialise(
            ends.groupBy(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).agg(F.sum("w").alias("w")), "edges"
        )
        fewer = materialise(
            strengths.join(merges, "id", "left").groupBy(F.coalesce("to", "id").alias("id")).agg(F.sum("k").alias("k")), "strengths"
        )
        level, strengths = shorter, fewer
    while rounds:
        merges = rounds.pop()
        later = names.select(F.col("id").alias("to"), F.col("to").alias("_last"))
        names = materialise(
            merges.join(later, "to", "left").select("id", F.coalesce("_last", "to").alias("to")).unionByName(names), "names"
        )
    return names


def numbered(member: DataFrame) -> DataFrame:
    """(id, community) with communities numbered from 0, the largest first, then by their smallest vertex."""
    sizes = member.groupBy("community").agg(F.count("*").alias("_n"), F.min("id").alias("_first"))
    numbers = materialise(position(sizes, [], [F.col("_n").desc(), F.col("_first").asc()], "_number"), "numbers")
    return member.join(numbers.select("community", "_number"), "community").select(
        "id", F.col("_number").alias("community")
    )


# ---------------------------------------------------------------- vertices that move

def _coin(name, salt):
    """Whether a community may receive vertices in a round; the others may lose some."""
    salt = F.lit(str(salt)) if isinstance(salt, int) else salt.cast("string")
    digit = F.substring(F.md5(F.concat_ws("|", salt, name.cast("string")).cast("binary")), 1, 1)
    return digit >= "8"


def better_places(edges: DataFrame, strengths: DataFrame, member: DataFrame, total: float, resolution: float = 1.0) -> DataFrame:
    """(id, from, to, gain, ...): every move of a vertex to a neighbour's community that raises the quality.

    gain, times total, is w_to - w_from - resolution * k * (s_to - (s_from - k)) / (2 total), to 9 decimals: w are
    the vertex's links into both communities without itself, s their strengths, k its own.
    """
    return _places(_placed(edges, member), _owned(strengths, member), total, resolution)


def _placed(edges: DataFrame, member: DataFrame) -> DataFrame:
    """(a, b, w, _a, _b), written: edges between two vertices and their communities."""
    ends = edges.filter(F.col("a") != F.col("b"))
    for side in ("a", "b"):
        ends = ends.join(member.select(F.col("id").alias(side), F.col("community").alias(f"_{side}")), side)
    return materialise(ends.select("a", "b", "w", "_a", "_b"), "placed-edges")


def _owned(strengths: DataFrame, member: DataFrame) -> DataFrame:
    """(id, from, k), written: vertices with their communities and strengths."""
    return materialise(member.select("id", F.col("community").alias("from")).join(strengths, "id"), "owned")


def _places(placed: DataFrame, owned: DataFrame, total: float, resolution: float) -> DataFrame:
    """better_places of the ends of edges between communities, which alone have any; only their links and the
    strengths of the communities that they touch are summed up.
    """
    across = materialise(placed.filter(F.col("_a") != F.col("_b")), "across")
    border = materialise(across.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "border")
    touched = materialise(across.select(F.explode(F.array("_a", "_b")).alias("from")).distinct(), "touched")
    both = placed.select(F.inline(F.array(
        F.struct(F.col("a").alias("id"), F.col("_b").alias("to"), "w"), F.struct(F.col("b").alias("id"), F.col("_a").alias("to"), "w")
    )))
    links = materialise(both.join(border, "id", "left_semi").groupBy("id", "to").agg(F.sum("w").alias("w")), "community-links")
    sums = materialise(owned.join(touched, "from", "left_semi").groupBy("from").agg(F.sum("k").alias("s")), "community-strengths")
    held = owned.join(border, "id", "left_semi").join(
        links.select("id", F.col("to").alias("from"), F.col("w").alias("w_from")), ["id", "from"], "left"
    )
    held = materialise(held.join(sums.withColumnRenamed("s", "s_from"), "from").fillna(0.0, ["w_from"]), "held")
    offers = links.join(held, "id").filter(F.col("to") != F.col("from")).join(
        sums.select(F.col("from").alias("to"), F.col("s").alias("s_to")), "to"
    )
    return offers.withColumn("gain", _moving_gain(total, resolution, F.lit(0.0), F.lit(0.0))).filter("gain > 0")


def _moving_gain(total: float, resolution: float, joined, left):
    """The gain of a move after vertices of these strengths have joined its target and left its source."""
    apart = (F.col("s_to") + joined) - (F.col("s_from") - F.col("k") - left)
    return F.round(F.col("w") - F.col("w_from") - resolution * F.col("k") * apart / (2 * total), 9)


def moving_round(places: DataFrame, total: float, resolution: float = 1.0, salt: int = 0) -> DataFrame:
    """(id, to): moves of one round, out of better_places; together they raise the quality.

    A coin per community, thrown anew with every salt, decides whether it receives or loses vertices, so
    no vertex joins a community that others leave. Every vertex asks for its best place. Those that join
    or leave one community are lined up by gain, and a move happens if its gain stays positive with all
    before it in both lines; links among those that move can only add to that.
    """
    open_places = places.filter(_coin(F.col("to"), salt) & ~_coin(F.col("from"), salt))
    rest = [c for c in places.columns if c not in ("id", "to", "gain")]
    best = open_places.groupBy("id").agg(F.min(F.struct((-F.col("gain")).alias("loss"), "to", *rest)).alias("_b"))
    asked = best.select("id", (-F.col("_b.loss")).alias("gain"), "_b.to", *[f"_b.{c}" for c in rest])
    order = [F.col("gain").desc(), F.col("id").asc()]
    lined = running_total(running_total(asked, ["to"], order, F.col("k"), "_joined"), ["from"], order, F.col("k"), "_gone")
    after = _moving_gain(total, resolution, F.col("_joined") - F.col("k"), F.col("_gone") - F.col("k"))
    return lined.filter(after > 0).select("id", "to")


#: Throws of the coins that are looked at together.
_THROWS = 64


def _open_throw(places: DataFrame, salt: int) -> int:
    """The first throw of the coins from salt on that leaves a move open; there is one, as all places differ from where they are left."""
    ways = materialise(places.select("from", "to").distinct(), "ways")
    while True:
        thrown = ways.withColumn("_salt", F.explode(F.sequence(F.lit(salt), F.lit(salt + _THROWS - 1))))
        first = thrown.filter(_coin(F.col("to"), F.col("_salt")) & ~_coin(F.col("from"), F.col("_salt"))).agg(F.min("_salt")).first()[0]
        if first is not None:
            return first
        salt += _THROWS


def moved(edges: DataFrame, strengths: DataFrame, member: DataFrame, total: float, resolution: float = 1.0) -> DataFrame:
    """member(id, community) after moving rounds until no vertex has a better place."""
    return _moved(edges, strengths, member, total, resolution)[0]


def _moved(edges: DataFrame, strengths: DataFrame, member: DataFrame, total: float, resolution: float) -> tuple[DataFrame, DataFrame]:
    """(moved(), communities(community) that lost a vertex at some time).

    Edges and vertices are joined with their communities once; rounds look up only the vertices moved since.
    """
    member = materialise(member.select("id", "community"), "members")
    placed, owned = _placed(edges, member), _owned(strengths, member)
    gone, lost, salt = None, member.select("community").limit(0), 0

    def now(table: DataFrame, vertex: str, community: str) -> DataFrame:
        if gone is None:
            return table
        looked = table.join(gone.select(F.col("id").alias(vertex), F.col("to").alias("_now")), vertex, "left")
        return looked.withColumn(community, F.coalesce("_now", community)).drop("_now")

    while True:
        ends = now(now(placed, "a", "_a"), "b", "_b")
        places = materialise(_places(ends, now(owned, "id", "from"), total, resolution), "better-places")
        if places.isEmpty():
            return now(member, "id", "community"), lost
        # A throw of the coins may leave no move open; the next one is thrown for the same places.
        salt = _open_throw(places, salt)
        moves = materialise(moving_round(places, total, resolution, salt), "moves")
        left = moves.join(places.select("id", F.col("from").alias("community")).distinct(), "id").select("community")
        lost = materialise(lost.unionByName(left).distinct(), "lost")
        gone = moves if gone is None else materialise(gone.join(moves, "id", "left_anti").unionByName(moves), "gone")
        salt += 1


def connected_parts(edges: DataFrame, member: DataFrame, doubtful: DataFrame | None = None) -> DataFrame:
    """member with every community split into its connected parts, named by their smallest vertex.

    Parts without a link between them gain nothing from being one community. Where doubtful(community) is given,
    all other communities are known to be connected and only take the name.
    """
    looked = member if doubtful is None else materialise(member.join(doubtful, "community", "left_semi"), "doubtful")
    ends = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    for side in ("src", "dst"):
        ends = ends.join(looked.select(F.col("id").alias(side), F.col("community").alias(f"_{side}")), side)
    inside = materialise(ends.filter(F.col("_src") == F.col("_dst")).select("src", "dst"), "inside")
    parts = connected_components(looked.select("id"), inside).withColumnRenamed("component", "community")
    if doubtful is None:
        return parts
    whole = member.join(doubtful, "community", "left_anti")
    least = materialise(whole.groupBy("community").agg(F.min("id").alias("_least")), "least")
    return whole.join(least, "community").select("id", F.col("_least").alias("community")).unionByName(parts.select("id", "community"))


def contracted(edges: DataFrame, strengths: DataFrame, member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """edges and strengths between the communities of member."""
    ends = edges
    for side in ("a", "b"):
        ends = ends.join(member.select(F.col("id").alias(side), F.col("community").alias(f"_{side}")), side)
    shorter = ends.groupBy(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).agg(F.sum("w").alias("w"))
    fewer = strengths.join(member, "id").groupBy(F.col("community").alias("id")).agg(F.sum("k").alias("k"))
    return materialise(shorter, "edges"), materialise(fewer, "strengths")


def moved_communities(vertices: DataFrame, edges: DataFrame, resolution: float = 1.0) -> DataFrame:
    """(id, community): communities of high modularity, connected, numbered by size from 0.

    Merges as in communities() are followed by moves of single vertices, disconnected communities are taken
    apart, and what is left may merge again, until neither a merge nor a move raises the quality.
    Every step raises it, so the result is never below that of communities().
    """
    base, strengths, total = start_tables(edges)
    member = vertices.select("id", F.col("id").alias("community"))
    while total:
        level = contracted(base, strengths, member)
        merged = merges_until_still(*level, total, resolution)
        names = merged.select(F.col("id").alias("community"), "to")
        joined = materialise(
            member.join(names, "community", "left").select("id", F.coalesce("to", "community").alias("community")), "members"
        )
        # Merges and joins follow links, so only a community that lost a vertex can fall apart.
        settled, lost = _moved(base, strengths, joined, total, resolution)
        member = materialise(connected_parts(base, materialise(settled, "members"), lost), "members")
        if merge_round(*contracted(base, strengths, member), total, resolution).isEmpty() and better_places(
            base, strengths, member, total, resolution
        ).isEmpty():
            break
    return numbered(member)
