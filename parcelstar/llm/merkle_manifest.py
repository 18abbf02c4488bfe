"""Merkle dataset manifest: aligned builders append nodes in postorder, proofs by position.

A tree takes ARITY nodes to a parent. Its leaves are cut into aligned blocks of 16³: a
block's subtree depends on its own leaves alone, so each builder hashes its block without
the others and appends every node to the block's log as it is completed, which is postorder.
The last node of a log is the block's root, a leaf of the next tier of blocks, until one is
left: three levels a tier, at most 4,096 nodes a task at a time, whatever the size of the
tree. Where a node stands in a log follows in closed form from the sizes of the subtrees
before it, so a proof reads its siblings from the log by position; nothing is searched.

Documents form a tree per source, in the order of their ids; the roots of the sources, in
the order of their names, form the tree of the dataset. Texts are hashed where they are read;
digests of 32 bytes move.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstar.llm.expressions import ascii_lower
from parcelstar.operators.joins import lookup_join
from parcelstar.operators.ordering import dense_keys, group_positions
from parcelstar.session import write_through

ARITY, LEVELS = 16, 3
BLOCK = ARITY**LEVELS
WIDTH = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:binary,right:binary>>"


# ---- one block


def parent(digests: bytes) -> bytes:
    """The digest of a run of nodes, whose digests are hashed as hex text."""
    return sha256(digests.hex().encode()).digest()


def height_of(n: int, alone: bool) -> int:
    """Levels above a block's leaves: all of them, or until one is left if it is the only one."""
    if not alone or n >= BLOCK:
        return LEVELS
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def append_log(leaves: list[bytes], height: int) -> bytes:
    """All nodes of a block in the order of their completion."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(height + 1)]

    def complete(level: int, digest: bytes) -> None:
        log.append(digest)
        open_runs[level].append(digest)
        if level < height and len(open_runs[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        complete(level + 1, parent(b"".join(run)))

    for leaf in leaves:
        complete(0, leaf)
    for level in range(height):
        if open_runs[level]:
            close(level)
    return b"".join(log)


def positions(n: int, height: int) -> list[np.ndarray]:
    """For each level the places of its nodes in the log of a block with `n` leaves.

    Before node i of level j stand its whole subtree, the i nodes of its level to the left,
    with their subtrees, and the higher nodes completed by those.
    """
    out = []
    for level in range(height + 1):
        i = np.arange(-(-n // ARITY**level))
        end = np.minimum((i + 1) * ARITY**level, n)  # leaves up to the end of the subtree
        below = sum((-(-end // ARITY**j) for j in range(level)), np.zeros_like(i))
        above = sum((i // ARITY ** (j - level) for j in range(level + 1, height + 1)), np.zeros_like(i))
        out.append(below + i + above)
    return out


class Block:
    """A block's log, with the siblings of any of its nodes."""

    def __init__(self, log: bytes, n: int, alone: bool) -> None:
        self.log, self.n, self.height = log, n, height_of(n, alone)
        self.at = positions(n, self.height)

    def node(self, level: int, index: int) -> bytes:
        start = int(self.at[level][index]) * WIDTH
        return self.log[start : start + WIDTH]

    def siblings(self, level: int, index: int) -> tuple[bytes, bytes]:
        """The digests of the run's nodes left and right of a node."""
        first = index // ARITY * ARITY
        last = min(first + ARITY, len(self.at[level]))
        nodes = [self.node(level, i) for i in range(first, last)]
        own = index - first
        return b"".join(nodes[:own]), b"".join(nodes[own + 1 :])

    def path(self, level: int, index: int) -> list[tuple[bytes, bytes]]:
        """Siblings level by level from a node up to the block's root."""
        out = []
        for j in range(level, self.height):
            out.append(self.siblings(j, index))
            index //= ARITY
        return out


def proof_digest(path: list[tuple[bytes, bytes]]) -> str:
    return sha256("".join(left.hex() + right.hex() for left, right in path).encode()).hexdigest()


def fold(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and the siblings of its path give."""
    for left, right in path:
        digest = parent(left + digest + right)
    return digest


# ---- trees of any size


def _logs(nodes: DataFrame) -> DataFrame:
    """A row per block of a tier: grp, block, n, log and what else the nodes carry, in order.

    `nodes` has grp, idx (from 0 in each group) and digest.
    """
    others = [c for c in nodes.columns if c not in ("grp", "idx", "digest")]
    blocks = (
        nodes.groupBy("grp", F.expr(f"idx div {BLOCK}").alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("idx", "digest", *others))).alias("items"))  # a block
        .select(
            "grp",
            "block",
            F.col("items.digest").alias("digests"),
            *[F.col(f"items.{c}").alias(c) for c in others],
        )
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("digests")
            logs, counts = [], []
            for number, leaves in zip(
                batch.column("block").to_pylist(), batch.column(at).to_pylist(), strict=True
            ):
                counts.append(len(leaves))
                logs.append(append_log(leaves, height_of(len(leaves), number == 0)))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(batch.num_columns) if i != at],
                    pa.array(counts, type=pa.int32()),
                    pa.array(logs, type=pa.binary()),
                ],
                names=[*[c for c in batch.schema.names if c != "digests"], "n", "log"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in blocks.columns if c != "digests")
    return write_through(blocks.mapInArrow(build, f"{schema}, n int, log binary"), "merkle-log")


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """The logs of all tiers over `nodes` (grp, idx, digest), the leaves' own first."""
    out = [_logs(nodes)]
    while not out[-1].where(F.col("block") > 0).isEmpty():
        roots = F.expr(f"substring(log, -{WIDTH}, {WIDTH})")
        out.append(_logs(out[-1].select("grp", F.col("block").alias("idx"), roots.alias("digest"))))
    return out


def _tier_paths(logs: DataFrame) -> DataFrame:
    """For each leaf of a tier its path to its block's root: grp, idx, up, path, top."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["log"], row["n"], row["block"] == 0)
                paths = [block.path(0, i) for i in range(block.n)]
                listed = [[{"left": a, "right": b} for a, b in path] for path in paths]
                kind = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["grp"]] * block.n, type=pa.string()),
                        pa.array([row["block"] * BLOCK + i for i in range(block.n)], type=pa.int64()),
                        pa.array([row["block"]] * block.n, type=pa.int64()),
                        pa.array(listed, type=kind),
                        pa.array([row["log"][-WIDTH:]] * block.n, type=pa.binary()),
                    ],
                    names=["grp", "idx", "up", "path", "top"],
                )

    schema = f"grp string, idx long, up long, path {PATH}, top binary"
    return logs.select("grp", "block", "n", "log").mapInArrow(walk, schema)


def paths_to_root(logs: list[DataFrame], from_tier: int = 0) -> DataFrame:
    """For each leaf of a tier the path to the root of its tree: grp, idx, path, root."""
    if from_tier == len(logs):  # above the last tier: its blocks are the roots
        return logs[-1].select(
            "grp",
            F.col("block").alias("idx"),
            F.array().cast(PATH).alias("path"),
            F.expr(f"substring(log, -{WIDTH}, {WIDTH})").alias("root"),
        )
    paths = _tier_paths(logs[-1]).select("grp", "idx", "path", F.col("top").alias("root"))
    for tier in reversed(logs[from_tier:-1]):
        above = paths.withColumnsRenamed({"idx": "up", "path": "_rest"})
        paths = _tier_paths(tier).join(above, ["grp", "up"]).select(
            "grp", "idx", F.concat("path", "_rest").alias("path"), "root"
        )
    return paths


# ---- documents


def record_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its UTF-8 bytes, `:` and value, or `-` if null."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(framed, fields)), 256))


def _placed(documents: DataFrame, presented: Column) -> DataFrame:
    """grp, idx, digest, doc_id and the presented digest of each document."""
    leaves = documents.select(
        F.coalesce(F.concat(F.lit("="), documents["source"]), F.lit("")).alias("grp"),
        documents["doc_id"].cast("long").alias("doc_id"),
        record_digest(*[documents[c] for c in FIELDS]).alias("digest"),
        presented.alias("presented"),
    )
    # Written first: the sort looks at the rows twice, and texts are to be hashed once.
    leaves = write_through(leaves, "merkle-leaves")
    return group_positions(leaves, ["grp"], ["doc_id", "digest", "presented"], "idx")


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row["log"], row["n"], row["block"] == 0)
            upper = [(p["left"], p["right"]) for p in row["path"]]
            subroot, root = row["subroot"].hex(), row["root"].hex()
            leaves, proofs, folded = [], [], []
            rest, run = [], -1
            for i, presented in enumerate(row["presented"]):
                leaf = block.node(0, i)
                if i // ARITY != run:  # what is above the run is the same for all its leaves
                    run = i // ARITY
                    rest = (block.path(1, run) if block.height else []) + upper
                path = ([block.siblings(0, i)] if block.height else []) + rest
                leaves.append(leaf.hex())
                proofs.append(proof_digest(path))
                folded.append(fold(leaf if presented is None else presented, path).hex())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_id"], type=pa.int64()),
                    pa.array(leaves),
                    pa.array([subroot] * block.n),
                    pa.array([root] * block.n),
                    pa.array(proofs),
                    pa.array(folded),
                    pa.array([f == root for f in folded]),
                ],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )


def manifest_proofs(documents: DataFrame, presented: Column | None = None) -> DataFrame:
    """Build the manifest of `documents` and check each presented record against it.

    `presented` is the digest (binary) of the record that somebody holds for the row, by
    default and where null the row's own. Returns a row per document row: doc_id, leaf, subroot
    (its source's root), root (the dataset's), proof_sha256 (of all sibling digests, level by
    level, left to right), folded_root (what the presented digest and the siblings give) and
    verified.

    Null fields are told from empty ones. Rows without source form a tree of their own, first
    of all; rows without id come first in their source. Rows that repeat an id are leaves of
    their own, in the order of their digests. A lone leaf is its source's root, a lone source
    the dataset's. Columns other than doc_id, source, lang, n_chars and text do not count. An
    empty table has no rows.
    """
    own = F.lit(None).cast("binary") if presented is None else presented
    logs = tiers(_placed(documents, own))
    upper = paths_to_root(logs, 1).withColumnRenamed("root", "subroot")  # a row per block
    subroots = write_through(
        paths_to_root(logs, len(logs)).select("grp", F.col("root").alias("subroot")), "merkle-subroots"
    )
    sources = write_through(dense_keys(subroots, ["grp"], "idx", 0), "merkle-sources")
    dataset = paths_to_root(
        tiers(sources.select(F.lit("").alias("grp"), "idx", F.col("subroot").alias("digest")))
    )
    ends = write_through(
        sources.select("grp", "idx").join(
            dataset.select("idx", F.col("path").alias("_last"), "root"), "idx"
        ).drop("idx"),
        "merkle-ends",
    )
    above = lookup_join(write_through(upper, "merkle-paths"), ends, ["grp"], "inner").select(
        "grp", F.col("idx").alias("block"), F.concat("path", "_last").alias("path"), "subroot", "root"
    )
    return (
        logs[0]
        .join(above, ["grp", "block"])
        .select("block", "n", "doc_id", "presented", "log", "path", "subroot", "root")
        .mapInArrow(
            _prove,
            "doc_id long, leaf string, subroot string, root string, proof_sha256 string,"
            " folded_root string, verified boolean",
        )
    )


def op12_merkle_manifest(documents: DataFrame) -> DataFrame:
    """Where 5 divides the CRC-32 of the decimal id, the record is presented in lower case."""
    lowered = [*[documents[c] for c in FIELDS[:-1]], ascii_lower(documents["text"])]
    tampers = F.crc32(documents["doc_id"].cast("string")) % 5 == 0
    return manifest_proofs(documents, F.when(tampers, record_digest(*lowered)))


def _oracle(levels: int, source_levels: int) -> str:
    """The same rows by a table per level, for trees of at most so many levels.

    A level holds (k, i, h): group, place and digest. A level of one node is its own parent.
    """

    def tree(prefix: str, first: str, count: int) -> str:
        steps = [f"{prefix}0 AS ({first})"]
        for j in range(count):
            steps.append(
                f"{prefix}r{j} AS (SELECT k, i // 16 AS r, list(h ORDER BY i) AS hs,"
                f" any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM {prefix}{j})"
                f" GROUP BY k, i // 16)"
            )
            steps.append(
                f"{prefix}{j + 1} AS (SELECT k, r AS i, CASE WHEN n = 1 THEN hs[1]"
                f" ELSE sha256(array_to_string(hs, '')) END AS h FROM {prefix}r{j})"
            )
        return ",\n".join(steps)

    def climb(name: str, start: str, prefix: str, count: int) -> str:
        steps = [f"{name}0 AS ({start})"]
        for j in range(count):
            steps.append(
                f"{name}{j + 1} AS (SELECT p.* REPLACE (p.i // 16 AS i,"
                f" CASE WHEN n = 1 THEN proof ELSE concat(proof, array_to_string(hs[:p.i % 16], ''),"
                f" array_to_string(hs[p.i % 16 + 2:], '')) END AS proof,"
                f" CASE WHEN n = 1 THEN cur ELSE sha256(concat(array_to_string(hs[:p.i % 16], ''), cur,"
                f" array_to_string(hs[p.i % 16 + 2:], ''))) END AS cur)"
                f" FROM {name}{j} p JOIN {prefix}r{j} t ON p.k = t.k AND p.i // 16 = t.r)"
            )
        return ",\n".join(steps)

    def digest(text: str) -> str:
        # concat() takes a null for empty, so nulls are caught first.
        parts = [
            f"CASE WHEN {c} IS NULL THEN '-'"
            f" ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
            for c in [*FIELDS[:-1], text]
        ]
        return f"sha256(concat({', '.join(parts)}))"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH bytes AS (
  SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), CAST(range(8) AS UBIGINT[])),
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS UBIGINT)) ELSE a // 2 END) AS v
  FROM (SELECT unnest(range(256)) AS b)),
crc32 AS (SELECT list(v ORDER BY b) AS vs FROM bytes),
d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE concat('=', source) END AS k,
    {digest('text')} AS leaf, {digest(lowered)} AS low,
    xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
      lambda a, x: xor(a // 256, vs[1 + CAST(xor(a, x) % 256 AS INTEGER)])),
      CAST(4294967295 AS UBIGINT)) AS crc
  FROM documents CROSS JOIN crc32),
o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS i
  FROM d),
{tree('n', 'SELECT k, i, leaf AS h FROM o', levels)},
s AS (
  SELECT k AS source_key, 0 AS k, CAST(row_number() OVER (ORDER BY encode(k)) - 1 AS BIGINT) AS i, h
  FROM n{levels}),
{tree('m', 'SELECT k, i, h FROM s', source_levels)},
{climb('p', '''SELECT k, i, doc_id, leaf, '' AS proof,
  CASE WHEN crc % 5 = 0 THEN low ELSE leaf END AS cur FROM o''', 'n', levels)},
{climb('q', f'''SELECT s.k, s.i, doc_id, leaf, proof, cur, s.h AS subroot
  FROM p{levels} p JOIN s ON p.k = s.source_key''', 'm', source_levels)}
SELECT doc_id, leaf, subroot, m.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
  cur = m.h AS verified
FROM q{source_levels} q CROSS JOIN m{source_levels} m
"""


#: Trees of up to 16⁶ documents a source and 16³ sources.
ORACLE = _oracle(6, 3)
