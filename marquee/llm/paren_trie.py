"""Conversation prefix trie in balanced parentheses.

Every conversation is a path of turns; a node is a distinct prefix.  The
paths, sorted, are cut into shards of about ``SHARD_NODES`` nodes.  A task
holds a shard's trie as a balanced-parentheses string:

* blocks of the excess (opened minus closed) keep their range minimum; a
  min-max tree over the blocks answers ``findclose``, which delimits a
  node's subtree;
* the rank of the leaf pairs ``()`` counts leaves between both ends;
* cumulative arrays in preorder give sums over a subtree (members, and the
  bytes that a shared prefix saves).

Only nodes on a shard's first and last path can occur in other shards.
These two *spines* leave the shard as paths again, each node with what hangs
on it (members, leaves, savings, children of its finished subtrees); the
spines of all shards are sorted, cut and merged in the same way, level by
level, until one shard holds them all.  All other nodes are finished.

Equal conversations are reduced before: sorted by (path, id), each run gives
one row for up to ``RUN`` members, with their ids written out, from which
the digest of a path's members is streamed.  A turn is known by a 128-bit
digest, a path element by the digest of its whole prefix, so a conversation
is carried in 16 bytes a turn, its text is not.

Cases: NULL role or text count as empty; turns go by turn (NULL first), then
role, then the digest of the text; repeated turns stay; rows with a NULL id
belong to no conversation; a conversation without turns is a member of the
root; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.store import Scratch

SHARD_NODES = 1 << 18       # path elements of a shard
RUN = 1 << 15               # members written into one row
BLOCK = 64                  # parentheses of an excess block
KEY = 16                    # bytes of a prefix digest
ROOT = bytes(KEY)

PATH = "path array<binary>, bytes array<long>"
#: What hangs on each node of a path (root first): members, members ending
#: there are among them, their smallest id, finished children, leaves, savings.
HANGS = "members array<long>, least array<long>, children array<long>, leaves array<long>, saved array<long>, digest array<string>"
SPINE = f"{PATH}, {HANGS}"
NODE = ("shard string, node binary, parent binary, parent_conv_id long, conv_id long, depth long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
OUT = f"kind string, {NODE}, {SPINE}"
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Parens:
    """A balanced-parentheses string (True: open) with range min-max blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        n = len(bits)
        self.excess = np.cumsum(np.where(bits, 1, -1).astype(np.int32))
        blocks = max(1, -(-n // BLOCK))
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:n] = self.excess
        self.low = [padded.reshape(blocks, BLOCK).min(axis=1)]          # range minima, leaves first
        while len(self.low[-1]) > 1:
            x = self.low[-1]
            if len(x) % 2:
                x = np.append(x, np.iinfo(np.int32).max)
            self.low.append(np.minimum(x[::2], x[1::2]))
        pairs = np.zeros(n, bool)
        pairs[:-1] = bits[:-1] & ~bits[1:]
        self.leaf_rank = np.concatenate([[0], np.cumsum(pairs)])        # leaf pairs before each place
        self.open_rank = np.concatenate([[0], np.cumsum(bits)])

    def _scan(self, at: np.ndarray, goal: np.ndarray, out: np.ndarray, todo: np.ndarray) -> np.ndarray:
        """Searches each query to the end of the block it stands in; the rest stays."""
        at = at.copy()
        while len(todo):
            inside = at < len(self.excess)
            hit = np.zeros(len(todo), bool)
            hit[inside] = self.excess[at[inside]] <= goal[inside]
            out[todo[hit]] = at[hit]
            at += 1
            more = ~hit & (at % BLOCK != 0)
            done = ~hit & ~more
            if done.any():
                self._left.append(todo[done])
            todo, at, goal = todo[more], at[more], goal[more]
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """For each open parenthesis the place of the one that closes it: the
        first place behind it whose excess falls under its own."""
        out = np.full(len(opens), -1, np.int64)
        goal = self.excess[opens] - 1
        self._left: list[np.ndarray] = []
        start = opens + 1
        fresh = start % BLOCK == 0                       # the next place starts another block
        if fresh.any():
            self._left.append(np.flatnonzero(fresh))
        todo = np.flatnonzero(~fresh)
        self._scan(start[todo], goal[todo], out, todo)
        left = np.concatenate(self._left) if self._left else np.empty(0, np.int64)
        # blocks: climb while the next blocks stay above the goal, then descend
        block = (opens[left] // BLOCK) + 1
        level = np.zeros(len(left), np.int64)
        active = np.arange(len(left))
        found = np.full(len(left), -1, np.int64)
        for h, low in enumerate(self.low):
            if not len(active):
                break
            b = block[active]
            ok = b < len(low)
            hit = np.zeros(len(active), bool)
            hit[ok] = low[b[ok]] <= goal[left[active[ok]]]
            found[active[hit]], level[active[hit]] = b[hit], h
            miss = active[~hit]
            # an even block's neighbour hangs on the same parent: look there first
            even = block[miss] % 2 == 0
            near = miss[even]
            nb = block[near] + 1
            ok = nb < len(low)
            hit = np.zeros(len(near), bool)
            hit[ok] = low[nb[ok]] <= goal[left[near[ok]]]
            found[near[hit]], level[near[hit]] = nb[hit], h
            active = np.concatenate([miss[~even], near[~hit]])
            block[active] = block[active] // 2 + 1
        for h in range(len(self.low) - 1, 0, -1):
            down = np.flatnonzero(level == h)
            if len(down):
                child = found[down] * 2
                right = self.low[h - 1][child] > goal[left[down]]
                found[down] = child + right
                level[down] = h - 1
        self._left = []
        self._scan(found * BLOCK, goal[left], out, left)
        return out


class Shard:
    """Trie of sorted paths, each node with what hangs on it."""

    def __init__(self, rows: list[dict]):
        m = len(rows)
        size = np.array([len(r["path"]) for r in rows], np.int64)          # elements, root included
        start = np.concatenate([[0], np.cumsum(size)])
        flat = lambda name, kind: np.concatenate([np.asarray(r[name], kind) for r in rows])
        keys = np.frombuffer(b"".join(k for r in rows for k in r["path"]), np.uint64).reshape(-1, 2)
        owner = np.repeat(np.arange(m), size)
        depth = np.arange(start[-1]) - start[owner]
        # elements shared with the path before: equal up to the first difference
        same = np.zeros(start[-1], bool)
        before = np.flatnonzero((owner > 0) & (depth < size[np.maximum(owner - 1, 0)]))
        same[before] = (keys[before] == keys[start[owner[before] - 1] + depth[before]]).all(axis=1)
        self.common = np.add.reduceat(same.astype(np.int64), start[:-1])      # a prefix digest differs from the first difference on
        fresh = ~same
        # node of each element: the last fresh one of its depth
        order = np.lexsort((owner, depth))
        number = np.empty(start[-1], np.int64)
        pre = np.cumsum(fresh) - 1                                            # preorder number of fresh elements
        heads = np.maximum.accumulate(np.where(fresh[order], np.arange(len(order)), -1))
        number[order] = pre[order[heads]]
        self.number, self.first = number, np.flatnonzero(fresh)
        n = self.n = len(self.first)
        self.depth = depth[self.first]
        self.parent = np.where(self.depth > 0, number[np.maximum(self.first - 1, 0)], -1)
        self.keys = keys[self.first]
        self.bytes = flat("bytes", np.int64)[self.first]
        total = lambda name: np.bincount(number, flat(name, np.int64).astype(float), n).astype(np.int64) if name != "saved" else self._sum(number, flat(name, np.int64), n)
        self.members, self.children, self.leaves, self.saved = (total(x) for x in ("members", "children", "leaves", "saved"))
        self.least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(self.least, number, flat("least", np.int64))
        self.digest: list = [None] * n
        for i, d in zip(number.tolist(), (d for r in rows for d in r["digest"])):
            if d is not None:
                self.digest[i] = d
        # ) for what the next path leaves, ( for what it adds
        turns = np.empty(2 * m + 1, np.int64)
        turns[0], turns[1::2], turns[-1] = 0, size - self.common, size[-1]
        turns[2:-1:2] = size[:-1] - self.common[1:]
        bits = np.repeat(np.arange(len(turns)) % 2 == 1, turns)
        self.parens = p = Parens(bits)
        opens = np.flatnonzero(bits)
        close = p.findclose(opens)
        self.end = p.open_rank[close]                                         # preorder end of each subtree
        inner = np.bincount(self.parent[self.parent >= 0], minlength=n)
        # leaf pairs, less those on which finished subtrees hang
        blocked = np.concatenate([[0], np.cumsum((inner == 0) & (self.children > 0))])
        at = np.arange(n)
        self.all_members = self._under(self.members)
        self.all_leaves = (p.leaf_rank[close] - p.leaf_rank[opens]) - (blocked[self.end] - blocked[at]) + self._under(self.leaves)
        self.all_saved = self._under(self.saved + (self.all_members - 1) * self.bytes)
        self.all_children = inner + self.children
        self.all_least = self.least.copy()
        for d in range(int(self.depth.max(initial=0)), 0, -1):
            here = self._at_depth(d)
            np.minimum.at(self.all_least, self.parent[here], self.all_least[here])

    @staticmethod
    def _sum(number, value, n):
        out = np.zeros(n, np.int64)
        np.add.at(out, number, value)
        return out

    def _under(self, value: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(value)])
        return c[self.end] - c[:-1]

    def _at_depth(self, d: int) -> np.ndarray:
        if not hasattr(self, "_by_depth"):
            self._by_depth = np.argsort(self.depth, kind="stable")
            self._edges = np.searchsorted(self.depth[self._by_depth], np.arange(self.depth.max(initial=0) + 2))
        return self._by_depth[self._edges[d]:self._edges[d + 1]]

    def nodes(self, pick: np.ndarray, done: np.ndarray, shard: str) -> pa.RecordBatch:
        """Finished nodes.  ``parent`` is set where the parent is on a spine,
        so that its smallest id is not known yet."""
        key = [self.keys[i].tobytes() for i in pick]
        above = self.parent[pick]
        here = (above >= 0) & done[above]
        up = [None if i < 0 or known else self.keys[i].tobytes() for i, known in zip(above, here)]
        cols = {"kind": pa.array(["node"] * len(pick)), "shard": pa.array([shard] * len(pick)), "node": pa.array(key, pa.binary()), "parent": pa.array(up, pa.binary()),
                "parent_conv_id": pa.array(self.all_least[above], mask=~here), "conv_id": pa.array(self.all_least[pick]), "depth": pa.array(self.depth[pick]), "n_convs": pa.array(self.all_members[pick]),
                "n_children": pa.array(self.all_children[pick]), "n_leaves": pa.array(self.all_leaves[pick]), "saved_tokens": pa.array(self.all_saved[pick]),
                "ends_sha256": pa.array([self.digest[i] or NO_ENDS for i in pick], pa.string())}
        return _batch(cols, len(pick))

    def spines(self, rows: list[dict], shard: str) -> pa.RecordBatch:
        """First and last path, with what hangs on each of their nodes."""
        size = [len(rows[0]["path"]), len(rows[-1]["path"])]
        last = len(self.number) - size[1]
        paths = [self.number[:size[0]]] + ([self.number[last:]] if len(rows) > 1 else [])
        on = np.zeros(self.n, bool)
        for p in paths:
            on[p] = True
        hang = np.flatnonzero(~on & (self.parent >= 0))
        hang = hang[on[self.parent[hang]]]                                    # tops of finished subtrees
        up = self.parent[hang]
        sums = {}
        for name, own, value in (("members", self.members, self.all_members), ("leaves", self.leaves, self.all_leaves), ("saved", self.saved, self.all_saved)):
            sums[name] = own + self._sum(up, value[hang], self.n)
        sums["children"] = self.children + np.bincount(up, minlength=self.n)
        least = self.least.copy()
        np.minimum.at(least, up, self.all_least[hang])
        sums["least"] = least
        given = np.zeros(self.n, bool)
        out: dict[str, list] = {k: [] for k in ("path", "bytes", "members", "least", "children", "leaves", "saved", "digest")}
        for p, row in zip(paths, (rows[0], rows[-1])):
            new = ~given[p]                                                   # a node of both paths is given once
            given[p] = True
            out["path"].append(list(row["path"]))
            out["bytes"].append(self.bytes[p].tolist())
            for name in ("members", "children", "leaves", "saved"):
                out[name].append(np.where(new, sums[name][p], 0).tolist())
            out["least"].append(np.where(new, least[p], np.iinfo(np.int64).max).tolist())
            out["digest"].append([self.digest[i] if f else None for i, f in zip(p.tolist(), new)])
        kinds = {"path": pa.list_(pa.binary()), "digest": pa.list_(pa.string())}
        cols = {k: pa.array(v, kinds.get(k, pa.list_(pa.int64()))) for k, v in out.items()}
        cols |= {"kind": pa.array(["spine"] * len(paths)), "shard": pa.array([shard] * len(paths))}
        return _batch(cols, len(paths))

    def finished(self, rows: list[dict]) -> np.ndarray:
        """Which nodes lie on neither spine."""
        done = np.ones(self.n, bool)
        done[self.number[:len(rows[0]["path"])]] = False
        done[self.number[len(self.number) - len(rows[-1]["path"]):]] = False
        return done


_TYPES = {"kind": pa.string(), "shard": pa.string(), "node": pa.binary(), "parent": pa.binary(), "parent_conv_id": pa.int64(), "conv_id": pa.int64(), "depth": pa.int64(),
          "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string(),
          "path": pa.list_(pa.binary()), "bytes": pa.list_(pa.int64()), "members": pa.list_(pa.int64()), "least": pa.list_(pa.int64()),
          "children": pa.list_(pa.int64()), "leaves": pa.list_(pa.int64()), "saved": pa.list_(pa.int64()), "digest": pa.list_(pa.string())}


def _batch(cols: dict, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([cols[k] if k in cols else pa.nulls(n, t) for k, t in _TYPES.items()], names=list(_TYPES))


def _rows(batches, step: int = 512):
    """Rows of the batches as tuples, a few at a time."""
    for b in batches:
        for i in range(0, b.num_rows, step):
            yield from zip(*(c.slice(i, step).to_pylist() for c in b.columns))


def _pack(rows, schema: pa.Schema, step: int = 256):
    """Record batches of some rows (dictionaries) each."""
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) >= step:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_PATH = [("path", pa.list_(pa.binary())), ("bytes", pa.list_(pa.int64()))]


def _rebuild(shared: int):
    """The conversations of a group, each with the first turns of its base."""
    def rebuilt(batches):
        for base, turns in _rows(batches):
            own: dict[int, list] = {}
            for t in turns:
                own.setdefault(t["conv_id"], []).append((t["digest"], t["bytes"]))
            head = own.get(base, [])
            for c in sorted(own):
                h = zlib.crc32(str(c).encode()) % (shared + 1)
                key, path, size = ROOT, [ROOT], [0]
                for digest, n in head[:h] + own[c][h:]:
                    key = hashlib.blake2b(key + digest, digest_size=KEY).digest()
                    path.append(key)
                    size.append(n)
                yield {"conv_id": c, "path": path, "bytes": size}

    return lambda batches: _pack(rebuilt(batches), pa.schema([("conv_id", pa.int64()), *_PATH]))


def rebuild(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            shared: int = 8, group: int = 5) -> DataFrame:
    """Rows (conv_id, path, bytes): each conversation c starts with the first
    crc32(c) mod (shared + 1) turns of conversation c - c mod group."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY))
    conv = F.col(conv_col).cast("long")
    rows = (turns.select((conv - conv % group).alias("base"), F.struct(conv.alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
                                                                      digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
            .where("t.conv_id is not null").groupBy("base").agg(F.sort_array(F.collect_list("t")).alias("t")))
    return rows.mapInArrow(_rebuild(shared), f"conv_id long, {PATH}")


def _runs(batches):
    """Consecutive equal paths, up to RUN members a row, with their ids as text."""
    def runs():
        now: dict | None = None
        for conv, path, size in _rows(batches):
            if now and (now["path"][-1] != path[-1] or len(now["path"]) != len(path) or now["n"] >= RUN):
                yield now | {"ids": ",".join(now["ids"])}
                now = None
            now = now or {"path": path, "bytes": size, "first_id": conv, "n": 0, "ids": []}
            now["ids"].append(str(conv))
            now["n"] += 1
        if now:
            yield now | {"ids": ",".join(now["ids"])}

    return _pack(runs(), pa.schema([*_PATH, ("first_id", pa.int64()), ("n", pa.int64()), ("ids", pa.string())]), 64)


def _members(batches):
    """One row a path, from its runs: what hangs on its nodes is its members."""
    now, sha = None, None
    for path, size, first, n, ids in _rows(batches):
        if now and now["path"][-1] == path[-1] and len(now["path"]) == len(path):
            sha.update(b"," + ids.encode())
            now["members"][-1] += n
            continue
        if now:
            now["digest"][-1] = sha.hexdigest()
            yield now
        sha, d = hashlib.sha256(ids.encode()), len(path) - 1
        now = {"path": path, "bytes": size, "members": [0] * d + [n], "least": [np.iinfo(np.int64).max] * d + [first],
               "children": [0] * (d + 1), "leaves": [0] * (d + 1), "saved": [0] * (d + 1), "digest": [None] * (d + 1)}
    if now:
        now["digest"][-1] = sha.hexdigest()
        yield now


def _spine_rows(batches):
    """Sorted spine paths; rows of one path may repeat, each adds what it holds."""
    for b in batches:
        for i in range(0, b.num_rows, 64):
            yield from b.slice(i, 64).to_pylist()


def _shards(read, level: int, most: int, last: bool):
    def run(batches):
        from pyspark import TaskContext
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        serial = 0

        def emit(rows):
            nonlocal serial
            shard, name = Shard(rows), f"{level}-{part}-{serial}"
            serial += 1
            done = np.ones(shard.n, bool) if last else shard.finished(rows)
            pick = np.flatnonzero(done)
            for i in range(0, len(pick), 8_192):
                yield shard.nodes(pick[i:i + 8_192], done, name)
            if not last:
                yield shard.spines(rows, name)
        rows, size = [], 0
        for r in read(batches):
            if rows and not last and size + len(r["path"]) > most:
                yield from emit(rows)
                rows, size = [], 0
            rows.append(r)
            size += len(r["path"])
        if rows:
            yield from emit(rows)
    return run


def trie(rebuilt: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The nodes of the prefix trie of rows (conv_id, path, bytes)."""
    scratch = Scratch(rebuilt.sparkSession, "trie")
    paths = scratch.save(rebuilt, "paths")
    # several paths to a shard, however long: two of them leave it, so every merge shrinks
    shard_nodes = max(shard_nodes, 8 * (paths.agg(F.max(F.size("path")).alias("n")).first().n or 0))
    runs = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_runs, f"{PATH}, first_id long, n long, ids string")
    runs = scratch.save(runs, "runs")
    work = runs.repartitionByRange("path").sortWithinPartitions("path", "first_id").select("path", "bytes", "first_id", "n", "ids")
    read, level, last, levels = _members, 0, False, []
    while True:
        done = scratch.save(work.mapInArrow(_shards(read, level, shard_nodes, last), OUT), f"level-{level}")
        levels.append(done)
        if last:
            break
        spine = done.where("kind = 'spine'").select("path", "bytes", "members", "least", "children", "leaves", "saved", "digest")
        size = spine.agg(F.sum(F.size("path")).alias("n")).first()
        level, read = level + 1, _spine_rows
        last = (size.n or 0) <= shard_nodes          # one shard holds the rest
        work = (spine.coalesce(1) if last else spine.repartitionByRange(max(1, -(-size.n // (2 * shard_nodes))), "path")).sortWithinPartitions("path")
    nodes = levels[0].where("kind = 'node'")
    for x in levels[1:]:
        nodes = nodes.unionByName(x.where("kind = 'node'"))
    nodes = nodes.select(*[c.split()[0] for c in NODE.split(", ")])
    # ids of parents on a spine: a spine node goes to each shard that holds it,
    # so that the children of one node are joined shard by shard
    finals = nodes.where(~F.col("shard").startswith("0-")).select("node", F.col("conv_id").alias("up"))
    held = None
    for x in levels[:-1]:
        spine = x.where("kind = 'spine'").select("shard", F.explode("path").alias("node")).distinct()
        held = spine if held is None else held.unionByName(spine)
    known = held.join(finals, "node").select("shard", F.col("node").alias("parent"), "up")
    late = nodes.where("parent is not null").join(known, ["shard", "parent"]).withColumn("parent_conv_id", F.col("up"))
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return nodes.where("parent is null").select(*out).unionByName(late.select(*out))
