"""Compressed uid sets: the stored form of a uid variable.

A set is rows (namespace, word, bits): `word` is the uid without its lowest six bits, bit k of
`bits` stands for the uid `64 * word + k`. A row takes the place of up to 64 uids, so dense
sets (uids given out in a row) shrink by the share of filled bits, and a set of strays is twice
its row form at the worst. All operations are whole-number expressions on these rows: any tree
of and, or and not over any number of sets is one grouping by word, folded before the shuffle;
counts need no uid at all. All 64 bits of a uid are kept, negative ones too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quadloom.model import namespace_of

KEY = ["namespace", "word"]
#: A name, or ("and" | "or", trees), or ("not", tree).
Tree = str | tuple


def _word(uid: Column) -> Column:
    return F.shiftright(uid.cast("bigint"), 6)


def _bit(uid: Column) -> Column:
    place = uid.cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _namespace(df: DataFrame) -> Column:
    return F.coalesce(namespace_of(df), F.lit(0)).alias("namespace")


def compress(variable: DataFrame, uid: str = "uid") -> DataFrame:
    """Rows with a uid as a set; null uids are no members, repeated ones count once."""
    u = F.col(uid)
    rows = variable.where(u.isNotNull()).select(_namespace(variable), _word(u).alias("word"), _bit(u).alias("bits"))
    return rows.groupBy(*KEY).agg(F.bit_or("bits").alias("bits"))


def members(uid_set: DataFrame) -> DataFrame:
    """(namespace, uid) of every member; made word by word, without a shuffle."""
    bits = F.col("bits")
    places = F.filter(F.array(*[F.lit(k) for k in range(64)]), lambda k: F.getbit(bits, k) == 1)
    rows = uid_set.select("namespace", "word", F.explode(places).alias("_place"))
    base = F.call_function("shiftleft", F.col("word"), F.lit(6))
    return rows.select("namespace", base.bitwiseOR(F.col("_place").cast("bigint")).alias("uid"))


def counts(uid_set: DataFrame) -> DataFrame:
    """One row per tenant: members, words that hold them, and `density`, the filled share."""
    members_of = F.sum(F.bit_count("bits").cast("bigint"))
    words = F.count(F.lit(1))
    return uid_set.groupBy("namespace").agg(
        members_of.alias("uids"), words.alias("words"), (members_of / (words * 64)).alias("density")
    )


def names(tree: Tree) -> set[str]:
    if isinstance(tree, str):
        return {tree}
    kind, body = tree
    return names(body) if kind == "not" else set().union(*map(names, body))


def bounded(tree: Tree) -> bool:
    """True if the tree holds no uid that none of its sets holds."""
    if isinstance(tree, str):
        return True
    kind, body = tree
    if kind == "not":
        return _full(body)
    return (any if kind == "and" else all)(map(bounded, body))


def _full(tree: Tree) -> bool:
    """True if the tree holds every uid that none of its sets holds."""
    if isinstance(tree, str):
        return False
    kind, body = tree
    if kind == "not":
        return bounded(body)
    return (all if kind == "and" else any)(map(_full, body))


def _bits(tree: Tree) -> Column:
    if isinstance(tree, str):
        return F.col(f"`{tree}`")
    kind, body = tree
    if kind == "not":
        return F.bitwise_not(_bits(body))
    parts = map(_bits, body)
    return reduce(Column.bitwiseAND if kind == "and" else Column.bitwiseOR, parts)


def evaluate(sets: dict[str, DataFrame], tree: Tree) -> DataFrame:
    """The set a tree of names stands for. One pass over each set the tree names and one
    grouping for all of them; a tree that would hold all other uids as well is refused."""
    used = sorted(names(tree))
    missing = [n for n in used if n not in sets]
    if missing:
        raise KeyError(f"no set named {', '.join(missing)}")
    if not bounded(tree):
        raise ValueError("the tree holds uids outside all its sets: give a set to subtract from")
    empty = F.lit(0).cast("bigint")
    parts = [
        sets[n].select(*KEY, *[(F.col("bits") if m == n else empty).alias(f"_{j}") for j, m in enumerate(used)])
        for n in used
    ]
    together = reduce(DataFrame.unionAll, parts)
    words = together.groupBy(*KEY).agg(*[F.bit_or(f"_{j}").alias(f"_{j}") for j in range(len(used))])
    named = words.select(*KEY, *[F.col(f"_{j}").alias(n) for j, n in enumerate(used)])
    return named.select(*KEY, _bits(tree).alias("bits")).where("bits <> 0")


def having(rows: DataFrame, uid_set: DataFrame, uid: str = "uid", negate: bool = False) -> DataFrame:
    """Rows whose uid is a member (`negate`: is none) in the row's tenant. The right side has
    one row per word, so a hot uid is split on the left as in every other join."""
    right = uid_set.select(F.col("namespace").alias("_ns"), F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    u = F.col(uid)
    on = (_namespace(rows) == F.col("_ns")) & (_word(u) == F.col("_word")) & (F.col("_bits").bitwiseAND(_bit(u)) != 0)
    return rows.join(right, on, "left_anti" if negate else "left_semi")


def changed(uid_set: DataFrame, changes: DataFrame, added: str = "added", order: Sequence[str] = ("seq",)) -> DataFrame:
    """The set after rows (uid, `order` columns, boolean `added`): for a uid the last change
    counts. Only the last change per uid is found by uid; the set itself stays compressed."""
    keyed = changes.where("uid is not null").select(
        _namespace(changes), "uid", F.struct(*order).alias("_at"), F.col(added).alias("_added")
    )
    last = keyed.groupBy("namespace", "uid").agg(F.max_by("_added", "_at").alias("_added"))
    put, gone = compress(last.where("_added")), compress(last.where("not _added"))
    return evaluate({"kept": uid_set, "put": put, "gone": gone}, ("or", ["put", ("and", ["kept", ("not", "gone")])]))
