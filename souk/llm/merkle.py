"""A manifest of a table as a Merkle tree, with a persistent version for every changed row.

A row's leaf is the digest of its fields. The leaves of a group (a source), in order of id, are
the base of the group's tree; runs of ``ARITY`` nodes become their digest until one is left, the
subroot. Subroots in order of group are the base of the upper tree, whose top is the root.

Trees are built in aligned blocks, ``LEVELS`` levels at a time, so no task holds more than a block: the tops of the blocks are the nodes of the next round. A node's path is
the siblings that it meets in its block, then those of its block in the rounds above.

A changed leaf makes a version of its block's tree by path copying: the nodes above the leaf are
new, all others are shared with the tree as it was. The version's top goes on through the path of
its block, so upper versions need no other row of the table.

Null fields count as ``-``; a null group is a group and comes first, as null ids do. Rows of equal
id are ordered by leaf; rows that are the same in all fields are leaves each, in any order. A
lone leaf is its subroot, and a lone subroot the root. An empty table gives no rows. Columns that
are not fields are not read, whatever their names. Texts of any length are digested whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from souk.llm import common
from souk.operators.numbering import number_within
from souk.sources.store import TableStore

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
# Levels of a block: a full one has ARITY ** LEVELS nodes
LEVELS = 7
# Rows of an Arrow batch of results
OUT_ROWS = 4096

PATH = "array<struct<at: int, siblings: array<string>>>"


def digest_of(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class Node:
    """A node of a persistent tree; a version shares the nodes that it doesn't change."""

    __slots__ = ("digest", "children")

    def __init__(self, digest: str, children: tuple[Node, ...] = ()):
        self.digest = digest
        self.children = children

    @classmethod
    def over(cls, children: Sequence[Node]) -> Node:
        return cls(digest_of(*(child.digest for child in children)), tuple(children))


def grown(digests: Sequence[str], levels: int | None) -> tuple[Node, int]:
    """The tree over a block, by this many levels or until one node is left, and its levels."""
    nodes, done = [Node(digest) for digest in digests], 0
    while len(nodes) > 1 if levels is None else done < levels:
        nodes = [Node.over(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
        done += 1
    return nodes[0], done


def turns(place: int, levels: int) -> list[int]:
    """The child to take at each level to reach a place, from the top."""
    return [place // ARITY**level % ARITY for level in reversed(range(levels))]


def siblings(tree: Node, way: Sequence[int]) -> list[tuple[int, list[str]]]:
    """(own place in the run, the run's others) on the way to a leaf, from the leaf up."""
    steps = []
    for at in way:
        others = [child.digest for i, child in enumerate(tree.children) if i != at]
        steps.append((at, others))
        tree = tree.children[at]
    return steps[::-1]


def version(tree: Node, way: Sequence[int], digest: str) -> Node:
    """The tree with another leaf: nodes on the way are copied, all others shared."""
    if not way:
        return Node(digest, tree.children)
    at = way[0]
    own = version(tree.children[at], way[1:], digest)
    return Node.over([*tree.children[:at], own, *tree.children[at + 1 :]])


def folded(digest: str, path: Sequence[tuple[int, Sequence[str]]]) -> str:
    """The top that a digest leads to through the siblings of its path."""
    for at, others in path:
        digest = digest_of(*others[:at], digest, *others[at:])
    return digest


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each (tree, block) of sorted batches; a block may span batches."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, block in groupby(rows, lambda row: (row["tree"], row["block"])):
        yield key, list(block)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = [pa.array(x, field.type) for x, field in zip(zip(*held), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield made()
            held = []
    if held:
        yield made()


def _block_tree(block: int, digests: Sequence[str], levels: int) -> tuple[Node, int]:
    """The first block of a tree grows until one node is left, which takes all levels if there
    are further blocks; those grow by all levels even over a single node."""
    return grown(digests, levels if block else None)


def _by_block(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _block(levels: int) -> Column:
    return F.floor(F.col("place") / ARITY**levels).alias("block")


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops of the blocks of (tree, place, digest): the nodes of the next round."""
    kind = nodes.schema["tree"].dataType.simpleString()
    schema = StructType.fromDDL(f"tree {kind}, place long, digest string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = (
            (*key, _block_tree(key[1], [row["digest"] for row in rows], levels)[0].digest)
            for key, rows in _blocks(batches)
        )
        return _batched(tops, arrow)

    own = nodes.select("tree", _block(levels), "place", "digest")
    return _by_block(own).mapInArrow(run, schema)


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes of every round, from the base to the tops of the trees."""
    rounds = [nodes]
    while True:
        rounds.append(common.written(_tops(rounds[-1], levels), "tops"))
        if rounds[-1].where("place > 0").isEmpty():
            return rounds


UP = f"path {PATH}, subroot string, root string"


def _paths(nodes: DataFrame, up: DataFrame, levels: int) -> DataFrame:
    """The nodes with path, subroot, root, and of those with another digest ``changed`` the
    ``version`` (the root that it leads to) and ``copied`` (the nodes of the version's own).

    ``up`` has (tree, place, path, subroot, root) of the blocks' tops.
    """
    names = [name for name in nodes.columns if name not in ("tree", "place")]
    added = StructType.fromDDL(f"{UP}, version string, copied int").fields
    kept = [nodes.schema[name] for name in ("tree", "place", *names)]
    schema = StructType([*kept, *added])
    arrow = to_arrow_schema(schema)

    def one(block: int, rows: list[dict]) -> Iterator[tuple]:
        # The row of the block's top comes before those of its nodes.
        head, own = rows[0], rows[1:]
        above = [(step["at"], step["siblings"]) for step in head["path"]]
        tree, height = _block_tree(block, [row["digest"] for row in own], levels)
        for row in own:
            way = turns(row["place"] % ARITY**levels, height)
            path = siblings(tree, way) + above
            root, copied = None, None
            if row.get("changed") is not None:
                root = folded(version(tree, way, row["changed"]).digest, above)
                copied = len(path) + 1
            steps = [{"at": at, "siblings": others} for at, others in path]
            values = (row["tree"], row["place"], *(row[name] for name in names))
            yield (*values, steps, head["subroot"], head["root"], root, copied)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((out for key, rows in _blocks(batches) for out in one(key[1], rows)), arrow)

    heads = up.select(
        "tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"),
        "path", "subroot", "root",
    )
    own = nodes.select("tree", _block(levels), "place", *names)
    return _by_block(own.unionByName(heads, allowMissingColumns=True)).mapInArrow(run, schema)


def _down(rounds: list[DataFrame], up: DataFrame, levels: int) -> DataFrame:
    """The nodes of the base as ``_paths`` gives them; ``up`` is about the tops of the trees."""
    for nodes in reversed(rounds[1:-1]):
        up = _paths(nodes, up, levels).select("tree", "place", "path", "subroot", "root")
        up = common.written(up, "paths")
    return _paths(rounds[0], up, levels)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with their place in their tree, from 0, as a written table."""
    store = TableStore.scratch(rows.sparkSession, f"merkle_{uuid.uuid4().hex}")
    out = number_within(rows, "tree", order, "place", store, "sorted")
    return common.written(out.withColumn("place", F.col("place") - 1), "nodes")


def field(value: Column) -> Column:
    """A field of a leaf: its length in UTF-8 bytes and its text, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def manifest(
    docs: DataFrame,
    changes: dict[str, Column] | None = None,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    id_column: str = "doc_id",
    levels: int = LEVELS,
) -> DataFrame:
    """(group, id, place, leaf, changed, path, subroot, root, version, copied) of every row.

    ``changes`` has other values of fields. A row whose leaf they change has that leaf in
    ``changed``, the root of its version in ``version``, and the nodes copied for it in
    ``copied``; these are null for other rows. A block has ``ARITY`` to the power of ``levels`` nodes.
    """
    common.ready(docs.sparkSession)
    values = {name: F.col(name) for name in fields}
    now, other = (
        F.sha2(F.concat(*[field(value) for value in row.values()]), 256)
        for row in (values, values | (changes or {}))
    )
    # Rows that are the same in all fields have to be dealt to several tasks too.
    tie = F.monotonically_increasing_id().alias("tie")
    leaves = docs.select(
        F.col(group).alias("tree"), F.col(id_column).alias("id"), now.alias("digest"),
        F.nullif(other, now).alias("changed"), tie,
    )
    leaves = common.written(leaves, "leaves")
    rounds = _rounds(_numbered(leaves, ["id", "digest", "tie"]).drop("tie"), levels)

    groups = rounds[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "digest")
    upper = _rounds(_numbered(groups, ["name"]), levels)
    root = F.col("digest").alias("root")
    top = upper[-1].select("tree", "place", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), root)
    over = _down(upper, top, levels).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "path",
        F.col("digest").alias("subroot"), "root",
    )
    found = _down(rounds, common.written(over, "groups"), levels)
    return found.select(
        F.col("tree").alias(group), F.col("id").alias(id_column), "place", F.col("digest").alias("leaf"),
        "changed", "path", "subroot", "root", "version", "copied",
    )


def without_line_ends(docs: DataFrame) -> dict[str, Column]:
    """The change that takes the line ends out of every text whose id has an even CRC-32."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


def proofs(docs: DataFrame) -> DataFrame:
    """Leaf, roots and digest of the siblings of every document, and whether its leaf, without
    line ends where ``without_line_ends`` takes them, still leads to the root."""
    found = manifest(docs, without_line_ends(docs))
    proof = F.sha2(F.array_join(F.flatten("path.siblings"), ""), 256)
    root = F.coalesce("version", "root")
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"),
        root.alias("folded_root"), (root == F.col("root")).alias("verified"),
    )


# CRC-32 goes byte by byte over the decimal id, bit by bit over a byte. Ties of id go by leaf.
ORACLE_SQL = r"""
with recursive rows_ as (
    select row_number() over () as r, doc_id, source, text,
        concat_ws('', {fields}) as joined, concat_ws('', {changed}) as other
    from (select *, case when list_reduce(
            list_prepend(4294967295, [ascii(c)::bigint for c in string_split(doc_id::varchar, '')]),
            lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
                lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
        ) & 1 = 1 then replace(text, chr(10), '') else text end as changed_text from documents)
),
leaves as (
    select r, doc_id, source, sha256(joined) as leaf, sha256(other) as changed,
        row_number() over (
            partition by source order by doc_id nulls first, sha256(joined), r) - 1 as place
    from rows_
),
nodes as (
    select 0 as level, source, place, leaf as digest, count(*) over (partition by source) as n
    from leaves
    union all
    select level + 1, source, place // 3, sha256(string_agg(digest, '' order by place)),
        any_value((n + 2) // 3)
    from nodes where n > 1 group by level, source, place // 3
),
tops as (
    select source, digest,
        row_number() over (order by source nulls first) - 1 as place
    from nodes where n = 1
),
upper as (
    select 0 as level, place, digest, count(*) over () as n from tops
    union all
    select level + 1, place // 3, sha256(string_agg(digest, '' order by place)),
        any_value((n + 2) // 3)
    from upper where n > 1 group by level, place // 3
),
-- Each node with the run's others before and behind it; upper levels follow those of the groups.
steps as (
    select l.r, n.level, n.level as step,
        coalesce(string_agg(o.digest, '' order by o.place)
            filter (o.place < n.place), '') as before,
        coalesce(string_agg(o.digest, '' order by o.place)
            filter (o.place > n.place), '') as behind
    from leaves l
    join nodes n on n.source is not distinct from l.source and n.n > 1
        and n.place = l.place // (3 ** n.level)::bigint
    left join nodes o on o.source is not distinct from n.source and o.level = n.level
        and o.place // 3 = n.place // 3 and o.place <> n.place
    group by l.r, n.level
    union all
    select l.r, n.level, 1000 + n.level,
        coalesce(string_agg(o.digest, '' order by o.place) filter (o.place < n.place), ''),
        coalesce(string_agg(o.digest, '' order by o.place) filter (o.place > n.place), '')
    from leaves l
    join tops t on t.source is not distinct from l.source
    join upper n on n.n > 1 and n.place = t.place // (3 ** n.level)::bigint
    left join upper o on o.level = n.level and o.place // 3 = n.place // 3 and o.place <> n.place
    group by l.r, n.level
),
paths as (
    select r, string_agg(before || behind, '' order by step) as siblings,
        list(struct_pack(a := before, b := behind) order by step) as path
    from steps group by r
),
folded as (
    select r, doc_id, l.source, leaf, coalesce(siblings, '') as siblings, list_reduce(
        list_prepend(struct_pack(a := changed, b := ''), coalesce(path, [])),
        lambda x, y: struct_pack(a := sha256(y.a || x.a || y.b), b := '')).a as folded_root
    from leaves l left join paths using (r)
)
select doc_id, leaf, t.digest as subroot, u.digest as root, sha256(siblings) as proof_sha256,
    folded_root, folded_root = u.digest as verified
from folded f
join tops t on t.source is not distinct from f.source
cross join (select digest from upper where n = 1) u
"""


def oracle_sql() -> str:
    """The statement of ``proofs``."""

    def one(name: str) -> str:
        value = f"{name}::varchar"
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    changed = ["changed_text" if name == "text" else name for name in FIELDS]
    return ORACLE_SQL.replace("{fields}", ", ".join(map(one, FIELDS))).replace(
        "{changed}", ", ".join(map(one, changed))
    )
