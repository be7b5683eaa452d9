"""Parent-child rows to full hierarchies: path, depth, root, descendants, and the nodes on loops.

Every node has at most one parent, within its scope (a scope is a forest, or one snapshot of cores). Leaves are peeled
from the bottom up; a peeled leaf sends its parent the size of its subtree and, where asked for, its list of descendants, in
long form. What is left when nothing can be peeled any more are the loops. Roots, depths and paths are handed down in
reverse peel order.

A round is a few jobs whatever it peels, and merger trees are a hundred levels deep with most nodes having one child
only. So a round peels many levels at once: each parent goes on in one of its children, its heir, a *chain* is a run of
heirs, and all nodes of a chain whose other children are peeled are peeled in one round, from the bottom up. Chains are found by pointer
jumping in a logarithmic number of rounds. With `chained=False` every node is a chain of its own: plain peeling, a
level per round. Rounds get small soon; when no more than TAIL chains are left, one task peels these to the end.

Rounds write their state to the shared folder, a folder per round and kind of row, and read only what is still open; no
row is ever sent to the driver but the ids of a bounded number of hot parents, whose joins are salted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..plans.cut import Parts, active, cut, drop, split, split_by, stored
from ..plans.ship import ship
from .skew import hot_keys, join_hot

KEY = ["scope", "id"]
CHAIN = ["scope", "chain"]
#: Pointers followed per job, after each other: a job makes them JUMPS + 1 times as long.
JUMPS = 3
#: Chains, checked to be no more, whose last rounds one task does.
TAIL = 10_000


@dataclass
class Peeled:
    """nodes: scope, id, note (what the caller gave), chain (id of the chain's topmost node), d (steps from it), of all nodes.
    rounds: the chains peeled in each, scope, chain, parent, pchain and at (the chain that it hangs on and the step
    there), length, fan (chains that hang on it), total (nodes in its subtree), round. tail: the chains of the last
    rounds, which one task did, with rooted (whether they don't lead into a loop) and then up, the chains above them, nearest
    first, and the steps there. residual: the chains that couldn't be peeled, all on loops."""

    nodes: DataFrame
    schema: T.StructType
    rounds: list[Parts] = field(default_factory=list)
    tail: Parts | None = None
    residual: Parts | None = None
    n: int = 0

    @property
    def chains(self) -> DataFrame:
        """All peeled chains."""
        parts = [*self.rounds, *([self.tail] if self.tail else [])]
        spark = self.nodes.sparkSession
        return Parts(spark, self.schema, [f for p in parts for f in p.folders]).read()


def pick_heirs(links: DataFrame) -> DataFrame:
    """scope, parent, heir, kids of each parent that has a row. The heir is the child of the highest `weight`, a column that
    links may have, then of the least id. Any choice gives the same hierarchy; with the (possibly wrong) size of the
    subtree as weight, chains nest only about log2(n) deep, and so few rounds of peeling are left. Maxima and counts are
    combined before the shuffle, so a parent of a third of all rows is no burden."""
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(0.0)) if "weight" in links.columns else F.lit(0.0)
    best = F.max(F.struct(weight.alias("w"), F.bitwise_not("id").alias("n"))).alias("top")
    child = links.where("parent is not null").groupBy("scope", "parent").agg(best, F.count("*").alias("kids"))
    child = child.join(links.select("scope", F.col("id").alias("parent")), ["scope", "parent"], "left_semi")
    return child.select("scope", "parent", F.bitwise_not("top.n").alias("heir"), "kids")


def label_chains(links: DataFrame, heirs: DataFrame | None) -> tuple[Parts, Parts]:
    """The nodes (scope, id, note, anc: the chain, d, done) and the tops of chains (the same with their parent) of links.

    Pointer jumping: a node that isn't at its chain's top knows an ancestor in its chain and the steps to it, and asks
    this one for its own, JUMPS times in a job. In a chain each node is asked by one other at most, so nothing is hot. A
    job in which no node gets done shows that all open ones lie on loops of heirs; such a loop is opened at its least id,
    and so is a chain that hangs on itself.
    """
    note = F.col("note") if "note" in links.columns else F.lit(None).cast("int")
    rows = links.select(*KEY, "parent", note.alias("note"))
    if heirs is None:
        rows = rows.withColumn("is_heir", F.lit(False))
    else:
        rows = rows.join(heirs.select("scope", F.col("heir").alias("id"), F.lit(True).alias("is_heir")), KEY, "left")
    step = F.coalesce("is_heir", F.lit(False))
    start = rows.select(*KEY, "note", F.when(step, F.col("parent")).otherwise(F.col("id")).alias("anc"), F.when(step, 1).otherwise(0).cast("long").alias("d"), (~step).alias("done"), "parent")
    tops, todo, seen = split(start, "chains", "done")
    below, nodes = todo, Parts(tops.spark, start.drop("parent").schema, tops.folders)
    while seen["no"]:
        goal = (nodes + todo).read().selectExpr("scope", "id as goal", "anc as anc2", "d as d2", "done as done2")
        moved = Parts(todo.spark, nodes.schema, todo.folders).read().selectExpr("*", "anc as goal")
        for _ in range(JUMPS):
            # a node that is done asks itself and keeps what it knows
            got = moved.join(goal, ["scope", "goal"])
            moved = got.selectExpr("scope", "id", "note", "if(done, anc, anc2) as anc", "if(done, d, d + d2) as d", "done or done2 as done", "if(done or done2, id, anc2) as goal")
        moved = moved.drop("goal")
        more, rest, now = split(moved, "chains", "done")
        nodes += more
        if not now["yes"]:
            opened, heads = _open_loops(below.read().join(rest.read().select(*KEY), KEY, "left_semi"))
            below.drop()
            return nodes + opened, tops + heads
        if todo is not below:
            todo.drop()
        todo, seen = rest, now
    below.drop()
    return nodes, tops


def _open_loops(loops: DataFrame) -> tuple[Parts, Parts]:
    """What `label_chains` gives, of nodes on loops of heirs. A node knows a stretch of the loop, from itself on, the least id
    there and the steps to it; stretches grow until none holds a lesser one."""
    whole = stored(loops, "loops")
    state = cut(whole.read().select(*KEY, "note", "parent", F.col("parent").alias("anc"), F.col("id").alias("top"), F.lit(0).cast("long").alias("d"), F.lit(1).cast("long").alias("width"), F.lit(False).alias("moved")), "loops")
    while True:
        goal = state.selectExpr("scope", "id as anc", "anc as anc2", "struct(top, d) as there", "width as width2")
        grown = state.selectExpr("*", "top as was")
        for _ in range(JUMPS):
            got = grown.join(goal, ["scope", "anc"]).selectExpr("*", "least(struct(top, d), struct(there.top as top, there.d + width as d)) as best")
            grown = got.selectExpr("scope", "id", "note", "parent", "anc2 as anc", "best.top as top", "best.d as d", "width + width2 as width", "was")
        state, seen = cut(grown.selectExpr("scope", "id", "note", "parent", "anc", "top", "d", "width", "was <> top as moved"), "loops", moved=active(F.col("moved")))
        if not seen["moved"]:
            break
    done = state.select(*KEY, "note", F.col("top").alias("anc"), "d", F.lit(True).alias("done"), "parent")
    return stored(done.drop("parent"), "loops"), stored(done.where("d = 0"), "loops")


def peel(nodes: Parts, tops: Parts, hot: list, n: int, tail: int = TAIL) -> Peeled:
    """Peels the chains leaf by leaf; each round sends the sizes and the number of the peeled ones to their parents, summed
    before the shuffle. A chain whose parent has no row hangs on nothing; `hot` are hot parents, of n children in all.
    When no more than `tail` chains are left, the rest of the rounds is one task's."""
    every = nodes.read().selectExpr("scope", "id", "note", "anc as chain", "d")
    length = every.groupBy(*CHAIN).agg(F.count("*").alias("length"))
    goal = every.selectExpr("scope", "id as parent", "chain as pchain", "d as at")
    heads = join_hot(tops.read().selectExpr("scope", "id as chain", "parent"), goal, ["scope", "parent"], "parent", hot, F.col("chain"), "left")
    graph, seen = cut(heads.join(length, CHAIN).selectExpr("scope", "chain", "parent", "pchain", "at", "length"), "graph", n=F.count("*"))
    hung = graph.where("pchain is not null").groupBy("scope", F.col("pchain").alias("chain")).agg(F.count("*").alias("fan"))
    state = graph.join(hung, CHAIN, "left").selectExpr(*graph.columns, "coalesce(fan, 0L) as fan", "length as total", "coalesce(fan, 0L) as left", "0 as round", "coalesce(fan, 0L) = 0 as peeled")
    out, left, rest = Peeled(every, state.schema, n=n), seen["n"], None
    while left:
        last = left <= tail
        if last:
            above = T.ArrayType(T.StructType([T.StructField("chain", T.LongType()), T.StructField("at", T.LongType())]))
            ends = T.StructType([*state.schema.fields, T.StructField("rooted", T.BooleanType()), T.StructField("up", above)])
            state = state.coalesce(1).mapInArrow(_peel_all, ends)
        leaves, more, seen = split(state, "peel", "peeled")
        if rest:
            rest.drop()
        else:
            drop(graph)
        rest, left = more, 0 if last else seen["no"]
        if seen["yes"] and last:
            out.tail = leaves
        elif seen["yes"]:
            out.rounds.append(leaves)
        if seen["no"] and (last or not seen["yes"]):
            out.residual = rest
            return out
        if left:
            sent = leaves.read().where("pchain is not null").groupBy("scope", F.col("pchain").alias("chain")).agg(F.sum("total").alias("more"), F.count("*").alias("gone"))
            less = "left - coalesce(gone, 0L)"
            state = rest.read().join(sent, CHAIN, "left").selectExpr(*graph.columns, "fan", "total + coalesce(more, 0L) as total", f"{less} as left", f"{len(out.rounds)} as round", f"{less} = 0 as peeled")
    return out


def _peel_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rounds for the few chains that are left: those peeled have the sizes of their subtrees and what is above them."""
    rows = [r for b in batches for r in b.to_pylist()]
    place = {(r["scope"], r["chain"]): i for i, r in enumerate(rows)}
    above = [None if r["pchain"] is None else place[r["scope"], r["pchain"]] for r in rows]
    leaves = [i for i, r in enumerate(rows) if r["left"] == 0]
    for i in leaves:  # grows while it is gone through
        rows[i]["peeled"] = True
        if above[i] is not None:
            to = rows[above[i]]
            to["total"], to["left"] = to["total"] + rows[i]["total"], to["left"] - 1
            if to["left"] == 0:
                leaves.append(above[i])
    for r in rows:
        r |= {"rooted": False, "up": []}
    for i in reversed(leaves):
        r, top = rows[i], None if above[i] is None else rows[above[i]]
        r["rooted"] = top is None or top["rooted"]
        if top is not None and top["rooted"]:
            r["up"] = [{"chain": top["chain"], "at": r["at"]}, *top["up"]]
    up = pa.list_(pa.struct([("chain", pa.int64()), ("at", pa.int64())]))
    kinds = {"scope": pa.int32(), "round": pa.int32(), "peeled": pa.bool_(), "rooted": pa.bool_(), "up": up}
    names = ["scope", "chain", "parent", "pchain", "at", "length", "fan", "total", "left", "round", "peeled", "rooted", "up"]
    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names=names)


def loop_nodes(peeled: Peeled) -> DataFrame:
    """scope, id, note of each node on a loop itself. A residual chain has exactly one residual child, which hangs at its
    step `at`; the loop runs from there up to the chain's top, so deeper nodes only lead into it."""
    if peeled.residual is None:
        return peeled.nodes.select(*KEY, "note").limit(0)
    return peeled.nodes.join(_entries(peeled), CHAIN).where("d <= entry").select(*KEY, "note")


def _entries(peeled: Peeled) -> DataFrame:
    return peeled.residual.read().groupBy("scope", F.col("pchain").alias("chain")).agg(F.max("at").alias("entry"))


def subtree_sizes(peeled: Peeled) -> DataFrame:
    """scope, id, note, chain, d, n_descendants of each node: those below it in the chain and in what hangs there. What hangs
    at one step is summed before the shuffle; the running sum goes along chains, from the bottom."""
    long = F.lit(1).cast("long")
    rows = peeled.nodes.select(*CHAIN, "d", "id", "note", long.alias("n"))
    hung = peeled.chains.where("pchain is not null").groupBy("scope", F.col("pchain").alias("chain"), F.col("at").alias("d")).agg(F.sum("total").alias("n"))
    note = peeled.nodes.schema["note"].dataType
    rows = rows.unionByName(hung.select(*CHAIN, "d", F.lit(None).cast("long").alias("id"), F.lit(None).cast(note).alias("note"), "n"))
    below = Window.partitionBy(*CHAIN).orderBy(F.col("d").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("n_descendants", F.sum("n").over(below) - 1).where("id is not null").select(*KEY, "note", "chain", "d", "n_descendants")


def chain_steps(peeled: Peeled, sizes: bool = True) -> DataFrame:
    """scope, chain and steps (d, id, note and, with `sizes`, n_descendants), its nodes from the top down: one array per
    chain, as long as the chain is deep."""
    rows, more = (subtree_sizes(peeled), ["n_descendants"]) if sizes else (peeled.nodes, [])
    return rows.groupBy(*CHAIN).agg(F.array_sort(F.collect_list(F.struct("d", "id", "note", *more))).alias("steps"))


def hand_down(peeled: Peeled, chains: DataFrame, with_path: bool = True, gap: bool = False) -> Parts:
    """`chains` (the peeled ones, with steps and whatever other columns) with what their tops know: root, base (the top's
    depth), nest (chains above), with `with_path` prefix, the ids from the root to the node that the chain hangs on, and with `gap` pos, the
    place of its top in the tree's order, where a chain comes `gap` places after the end of the one it hangs on.

    In reverse peel order each chain learns this from the chain it hangs on, which knows it by then. Chains that lead
    into a loop have nulls.
    """
    n = len(peeled.rounds) + (peeled.tail is not None)
    if not n:
        return _empty(chains, with_path, gap)
    # a chain that other rounds read is hot only if much hangs on it
    hot = hot_keys(peeled.chains, "chain", "fan", peeled.n)
    columns, parts = chains.columns, split_by(chains, "tree", "round", range(n))
    top = {"root": "chain", "base": "0L", "nest": "0"} | ({"prefix": "cast(array() as array<bigint>)"} if with_path else {}) | ({"pos": "0L"} if gap else {})
    named = lambda found: [f"{found[k]} as {k}" for k in top]
    known: Parts | None = None
    if peeled.tail:
        last = parts.pop()
        known = stored(_tail_facts(last.read(), peeled.tail.read(), named, with_path, gap), "facts")
        last.drop()
    for part in reversed(parts):
        rows = part.read()
        new = rows.where("pchain is null").selectExpr(*columns, *named(top))
        if known:
            above = known.read().selectExpr("scope", "chain as pchain", "root", "base", "nest", *(["prefix", "steps.id as ids"] if with_path else []), *(["pos", "length as plength"] if gap else []))
            got = join_hot(rows.where("pchain is not null"), above, ["scope", "pchain"], "pchain", hot, F.col("chain"), "left")
            onto = {"root": "root", "base": "base + at + 1", "nest": "nest + 1", "prefix": "concat(prefix, slice(ids, 1, cast(at + 1 as int)))", "pos": "pos + plength + gap"}
        else:
            # nothing but residual chains is left above these
            got, onto = rows.where("pchain is not null"), {k: f"cast(null as {new.schema[k].dataType.simpleString()})" for k in top}
        made = stored(new.unionByName(got.selectExpr(*columns, *named(onto))), "facts")
        known = made if known is None else known + made
        part.drop()
    return known


def _tail_facts(rows: DataFrame, tail: DataFrame, named: Callable[[dict], list[str]], with_path: bool, gap: bool) -> DataFrame:
    """`rows` of the tail's chains with what their tops know, from the chains above each."""
    ups = rows.join(tail.select(*CHAIN, "rooted", "up"), CHAIN)
    of = rows.selectExpr("scope", "chain as over", *(["steps.id as ids"] if with_path else []), *(["length as olength", "gap as ogap"] if gap else []))
    each = ups.where("size(up) > 0").selectExpr("scope", "chain", "posexplode(up) as (k, u)").selectExpr("scope", "chain", "k", "u.chain as over", "u.at as uat").join(of, ["scope", "over"])
    sums = [F.max_by("over", "k").alias("top"), F.sum(F.col("uat") + 1).alias("base")]
    if with_path:
        sums.append(F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("k"), F.slice("ids", F.lit(1), (F.col("uat") + 1).cast("int")).alias("ids")))).alias("pieces"))
    if gap:
        sums.append(F.sum(F.col("olength") + F.coalesce("ogap", F.lit(0))).alias("before"))
    found = {"root": "if(rooted, coalesce(top, chain), null)", "base": "if(rooted, coalesce(base, 0L), null)", "nest": "if(rooted, size(up), null)", "prefix": "if(rooted, coalesce(flatten(pieces.ids), cast(array() as array<bigint>)), null)", "pos": "coalesce(before + gap, 0L)"}
    return ups.join(each.groupBy(*CHAIN).agg(*sums), CHAIN, "left").selectExpr(*rows.columns, *named(found))


def _empty(chains: DataFrame, with_path: bool, gap: bool) -> Parts:
    none = {"root": "long", "base": "long", "nest": "int"} | ({"prefix": "array<bigint>"} if with_path else {}) | ({"pos": "long"} if gap else {})
    return Parts(chains.sparkSession, chains.select("*", *(F.lit(None).cast(t).alias(k) for k, t in none.items())).schema, [])


def hierarchy(peeled: Peeled, with_path: bool = True, with_note: bool = False) -> DataFrame:
    """Per node not on a loop: scope, id, (note,) root, depth, path (ids from the root to the node) and n_descendants. Nodes
    that lead into a loop have null root, depth and path, but their descendants count. Nodes on loops have no row.

    Facts are found per chain and only then spread over its nodes, so no path is ever shuffled."""
    steps = chain_steps(peeled)
    chains = peeled.chains.select(*CHAIN, "pchain", "at", "round").join(steps, CHAIN)
    known = hand_down(peeled, chains, with_path).read().withColumn("entry", F.lit(None).cast("long"))
    if peeled.residual is not None:
        facts = {k: F.lit(None).cast(known.schema[k].dataType).alias(k) for k in known.columns if k not in ("scope", "chain", "steps", "entry")}
        known = known.unionByName(steps.join(_entries(peeled), CHAIN).select(*CHAIN, "steps", "entry", *facts.values()))
    path = []
    if with_path:
        known = known.withColumn("ids", F.col("steps.id"))
        path = [F.concat("prefix", F.slice("ids", F.lit(1), F.col("k") + 1)).alias("path")]
    rows = known.select("*", F.posexplode("steps").alias("k", "s")).where("entry is null or k > entry")
    return rows.select("scope", "s.id", *(["s.note"] if with_note else []), "root", (F.col("base") + F.col("k")).alias("depth"), *path, "s.n_descendants")


def descendants(tree: DataFrame) -> DataFrame:
    """scope, id, descendant, distance: every pair of a node and a node below it, from the paths of `hierarchy`."""
    steps = tree.where("path is not null").select("scope", F.col("id").alias("descendant"), "depth", F.posexplode("path").alias("at", "id"))
    return steps.where("at < depth").select("scope", "id", "descendant", (F.col("depth") - F.col("at")).alias("distance"))


def descendant_lists(peeled: Peeled) -> DataFrame:
    """The same pairs from lists sent up: each round the peeled chains send what is in their lists to the chains they hang
    on. A list is in long form and shared by the nodes of its chain: descendant, at (the lowest step of the chain that it
    is below of, or its own step), distance (from the node there); so a node is in as many lists as there are chains above it,
    and in the last step each entry is spread over the nodes above it. Nodes on loops, or leading into one, have no
    descendants here."""
    facts = hand_down(peeled, peeled.chains.select(*CHAIN, "pchain", "at", "round").join(chain_steps(peeled, sizes=False), CHAIN), with_path=False).read()
    rooted = facts.where("root is not null").select(*CHAIN, "pchain", "at", "round", F.col("steps.id").alias("ids"))
    nodes = rooted.select(*CHAIN, "round", F.posexplode("ids").alias("at", "descendant")).select(*CHAIN, "round", "descendant", F.col("at").cast("long").alias("at"), F.lit(0).cast("long").alias("distance"))
    hot, big = hot_keys(peeled.chains, "chain", "fan", peeled.n), hot_keys(peeled.chains, "chain", "total", peeled.n)
    when = peeled.chains.selectExpr("scope", "chain as pchain", "round as pround")
    sends = cut(join_hot(rooted.where("pchain is not null").drop("ids"), when, ["scope", "pchain"], "pchain", hot, F.col("chain")).selectExpr("scope", "chain", "pchain", "at as pat", "round", "pround"), "sends")
    lists = stored(nodes, "lists")
    out, made = lists, [lists]
    for r in range(len(peeled.rounds)):
        ready = sum(made[1:], made[0]).read().where(F.col("round") == r).drop("round")
        up = join_hot(ready, sends.where(F.col("round") == r).drop("round"), CHAIN, "chain", big, F.col("descendant"))
        made.append(stored(up.selectExpr("scope", "pchain as chain", "pround as round", "descendant", "pat as at", "at + distance + 1 as distance"), "lists"))
        out += made[-1]
    if peeled.tail:
        # a list of the tail goes to all chains above at once
        ready = out.read().where(F.col("round") == len(peeled.rounds)).drop("round")
        ups = peeled.tail.read().where("size(up) > 0").selectExpr("scope", "chain", "posexplode(transform(up, (u, i) -> struct(u.chain as over, u.at as uat, aggregate(slice(up, 1, i), 0L, (n, v) -> n + v.at + 1) as more))) as (k, u)")
        up = ready.join(ups.selectExpr("scope", "chain", "u.over", "u.uat", "u.more"), CHAIN)
        out += stored(up.selectExpr("scope", "over as chain", f"{len(peeled.rounds)} as round", "descendant", "uat as at", "at + distance + 1 + more as distance"), "lists")
    ids = rooted.select(*CHAIN, "ids")
    entries = join_hot(out.read(), ids, CHAIN, "chain", big, F.col("descendant"))
    # of its own chain a node is below those before it, of another also below the one at that step
    count = F.when(F.col("distance") == 0, F.col("at")).otherwise(F.col("at") + 1).cast("int")
    pairs = entries.where(count > 0).select("scope", "descendant", "at", "distance", F.posexplode(F.slice("ids", F.lit(1), count)).alias("k", "id"))
    return pairs.select("scope", "id", "descendant", (F.col("distance") + F.col("at") - F.col("k")).alias("distance"))


def resolve(links: DataFrame, chained: bool = True, tail: int = TAIL) -> Peeled:
    """The peeled hierarchy of links (scope, id, parent and, if wanted, weight and a note of any type, which comes out with the
    node): one row per node, parent null for a root. An empty table gives an empty hierarchy; the caller drops rows
    whose id is null. With `chained` many levels are peeled in a round, else one."""
    ship(links.sparkSession)
    links = links.withColumn("scope", F.col("scope").cast("int"))
    kids, seen = cut(pick_heirs(links), "kids", n=F.sum("kids"))
    hot = hot_keys(kids, "parent", "kids", seen["n"])
    nodes, tops = label_chains(links, kids if chained else None)
    drop(kids)
    return peel(nodes, tops, hot, seen["n"], tail)
