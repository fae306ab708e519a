"""Reconciliation: names and ids to canonical keys, never guessing (D1-D40). Every step is a join or a column rule; nothing is looked up row by row."""

from __future__ import annotations

import json
import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import trees
from .graph import cut

#: Name classes that may resolve a mention (fixed values).
NAME_CLASSES = ("scientific name", "synonym", "equivalent name", "genbank synonym", "includes")
#: Ranks from broad to narrow (fixed values).
RANKS = (
    "acellular root", "cellular root", "realm", "subrealm", "domain", "superkingdom", "kingdom", "subkingdom", "superphylum", "phylum", "subphylum",
    "superclass", "class", "subclass", "infraclass", "cohort", "subcohort", "superorder", "order", "suborder", "infraorder", "parvorder", "superfamily",
    "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "section", "subsection", "series", "subseries", "species group", "species subgroup",
    "species", "forma specialis", "subspecies", "varietas", "subvariety", "forma", "serogroup", "serotype", "biotype", "genotype", "morph", "pathogroup",
    "strain", "isolate",
)
#: Ranks below a species (fixed values), and those that say nothing by themselves.
BELOW_SPECIES = ("no rank", "strain", "subspecies", "varietas", "isolate", "forma specialis", "forma", "serotype", "clade", "serogroup", "genotype", "biotype", "morph", "pathogroup", "subvariety")
UNDECIDED = ("no rank", "clade")
#: Marks of a placeholder name (fixed values).
PLACEHOLDERS = ("uncultured", "unclassified", "unidentified", "environmental sample")
#: Words that close an author's name (fixed values).
AUTHOR_WORDS = ("et", "al.", "al", "and", "&", "ex", "emend.", "corrig.")
#: What full case folding makes of characters that lower-casing leaves, by the rule of the Unicode tables.
FOLDS = {c: f for c in map(chr, range(sys.maxunicode + 1)) if (f := c.lower().casefold()) != c.lower() and c == c.lower()}
SINGLE = {c: f for c, f in FOLDS.items() if len(f) == 1}
MULTIPLE = {c: f for c, f in FOLDS.items() if len(f) > 1}


def casefold(text: Column) -> Column:
    """Full case folding: characters that fold to one are translated, those that fold to several are replaced where there are any."""
    text = F.translate(F.lower(text), "".join(SINGLE), "".join(SINGLE.values()))
    return F.when(text.rlike(f"[{''.join(MULTIPLE)}]"), _unfolded(text)).otherwise(text)


def _unfolded(text: Column) -> Column:
    """Each character by its folding, looked up in one map."""
    table = F.from_json(F.lit(json.dumps(MULTIPLE)), "map<string,string>")  # one literal in the plan, folded once
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")


#: What a name's authors begin with: a parenthesis or a year; a quoted head (fixed values).
AUTHORS_FROM, QUOTED_HEAD = r"\(|\b(?:1[6-9]\d{2}|20\d{2})\b", '^"([^"]+)"'


def is_placeholder(name: Column) -> Column:
    low = casefold(F.trim(name))
    test = F.trim(name).startswith("[") | low.startswith("candidatus ") | low.endswith(" sp.") | low.contains(" sp. ") | low.endswith(" spp.") | low.contains(" spp. ")
    for mark in PLACEHOLDERS:
        test = test | low.contains(mark)
    return F.coalesce(test & (name != ""), F.lit(False))


def strip_authority(name: Column) -> Column:
    """The bare name of one with authors: a quoted head; else what stands before the first parenthesis or year, without trailing author
    words as long as more than two words are left. A name with neither stays as it is."""
    s = F.trim(name)
    quoted = F.regexp_extract(s, QUOTED_HEAD, 1)
    head = F.regexp_extract(s, rf"^(.*?)(?:{AUTHORS_FROM})", 1)
    cut = s.rlike(AUTHORS_FROM)
    words = F.filter(F.split(head, r"\s+"), lambda w: w != "")
    closes = lambda w: F.lower(w).isin(*AUTHOR_WORDS) | w.rlike(r"^\p{Lu}")
    # the words that stay: the first two, and all up to the last one that is no author word
    kept = F.aggregate(
        F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        F.lit(2),
        lambda n, x: F.when((x["i"] >= 2) & ~closes(x["w"]), x["i"] + 1).otherwise(n),
    )
    bare = F.array_join(F.slice(words, F.lit(1), kept), " ")
    return F.when(quoted != "", F.trim(quoted)).when(cut, bare).otherwise(s)


def name_index(names: DataFrame) -> DataFrame:
    """(key, ids, spelling) over the resolving classes; names: tax_id, name, name_class."""
    rows = names.filter(F.col("name_class").isin(*NAME_CLASSES)).select(casefold(F.trim("name")).alias("key"), "tax_id", "name", "name_class")
    return rows.groupBy("key").agg(F.array_sort(F.collect_set("tax_id")).alias("ids"), F.min("name").alias("spelling"), F.bool_or(F.col("name_class") == "scientific name").alias("scientific"))


def stripped_index(names: DataFrame) -> DataFrame:
    rows = names.filter(F.col("name_class").isin(*NAME_CLASSES)).withColumn("bare", strip_authority(F.col("name"))).filter("bare != name and bare != ''")
    return name_index(rows.withColumn("name", F.col("bare")))


def merged_map(merged: DataFrame) -> DataFrame:
    """(old_id, new_id) followed to the end; a cycle leads nowhere. Of several new ids of an old one the least counts."""
    once = merged.groupBy(F.col("old_id").alias("child")).agg(F.min("new_id").alias("parent"))
    return trees.ends(once).filter("node != root").select(F.col("node").alias("old_id"), F.col("root").alias("new_id"))


def rank_depth(rank: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(r) for r in RANKS]), F.lower(F.trim(rank)))
    return F.when(at > 0, at)


def below_ceiling(rank: Column, ceiling: str = "species") -> Column:
    """Whether a rank is narrower than the ceiling; null where the rank alone cannot say. Below a species is a closed list; other ceilings go by the ladder."""
    text = F.lower(F.trim(F.coalesce(rank, F.lit(""))))
    if ceiling == "species":
        return F.when(~text.isin(*UNDECIDED), text.isin(*BELOW_SPECIES))
    return rank_depth(text) > RANKS.index(ceiling) + 1


def at_or_below(rank: Column, ceiling: str = "species") -> Column:
    """The same for an ancestor that places an undecided taxon: the ceiling itself counts."""
    return (F.lower(F.trim(F.coalesce(rank, F.lit("")))) == ceiling) | below_ceiling(rank, ceiling)


def promotions(nodes: DataFrame, ceiling: str = "species") -> DataFrame:
    """(tax_id, promoted_id): the nearest ancestor that is not below the ceiling, for every taxon below it. A rank that cannot say ('no rank', 'clade') is
    below if its nearest decided ancestor is at or below the ceiling. Computed once for the whole tree (tax_id, parent_id, rank)."""
    rank = F.col("rank")
    placed = nodes.select("tax_id", "parent_id", below_ceiling(rank, ceiling).alias("below"), at_or_below(rank, ceiling).alias("under"))
    facts = placed.select(F.col("tax_id").alias("node"), F.when(F.col("below") == F.lit(False), F.col("tax_id")).alias("target"), "under")
    above = trees.nearest(placed.select(F.col("tax_id").alias("child"), F.col("parent_id").alias("parent")), facts, ["target", "under"])
    own = placed.join(above.select(F.col("node").alias("tax_id"), "target", F.col("under").alias("nearest")), "tax_id", "left")
    below = F.coalesce("below", "nearest", F.lit(False))
    return own.select("tax_id", F.when(below & F.col("target").isNotNull(), F.col("target")).otherwise(F.col("tax_id")).alias("promoted_id"))


def prepare(names: DataFrame, nodes: DataFrame, merged: DataFrame, deleted: DataFrame, ceiling: str | None = "species", written: bool = True) -> dict[str, DataFrame]:
    """What every resolution against one taxonomy looks up, written once unless it is used once: names, bare names, old ids, deleted ids, ranks and promotions."""
    keep = cut if written else (lambda df: df)
    up = promotions(nodes, ceiling) if ceiling else nodes.select("tax_id", F.col("tax_id").alias("promoted_id"))
    return {
        "exact": keep(name_index(names).select("key", F.col("ids").alias("e_ids"), F.col("spelling").alias("e_name"), F.col("scientific").alias("e_sci"))),
        "bare": keep(stripped_index(names).select("key", F.col("ids").alias("s_ids"), F.col("spelling").alias("s_name"))),
        "merged": keep(merged_map(merged).withColumnRenamed("old_id", "start")),
        "deleted": keep(deleted.select(F.col("tax_id").alias("live"), F.lit(True).alias("is_deleted"))),
        "taxa": keep(nodes.select(F.col("tax_id").alias("live"), F.col("rank").alias("original_rank")).join(up.withColumnRenamed("tax_id", "live"), "live", "left")),
    }


def resolve(mentions: DataFrame, names: DataFrame, nodes: DataFrame, merged: DataFrame, deleted: DataFrame, ceiling: str | None = "species") -> DataFrame:
    """resolve_with over a taxonomy that is used once."""
    return resolve_with(mentions, prepare(names, nodes, merged, deleted, ceiling, written=False))


def resolve_with(mentions: DataFrame, index: dict[str, DataFrame]) -> DataFrame:
    """mentions (name, given_id) -> the same with tax_id, status, matched_name, original_tax_id, original_rank, normalized, candidates, note.
    Distinct mentions are resolved, then joined back. An id beats a name; an exact name beats a bare one; a name of two taxa resolves to none."""
    asked = mentions.select("name", "given_id").distinct().withColumn("key", casefold(F.trim("name")))
    got = asked.join(index["exact"], "key", "left").join(index["bare"], "key", "left")
    ids = F.coalesce("e_ids", "s_ids")
    by_name = F.when(F.size(ids) == 1, F.element_at(ids, 1))
    got = got.withColumn("start", F.coalesce("given_id", by_name)).withColumn("ambiguous", F.col("given_id").isNull() & (F.coalesce(F.size(ids), F.lit(0)) > 1))
    got = got.join(index["merged"], "start", "left").withColumn("live", F.coalesce("new_id", "start"))
    got = got.join(index["deleted"], "live", "left").join(index["taxa"], "live", "left")
    normalized = F.col("given_id").isNull() & F.col("e_ids").isNull() & F.col("s_ids").isNotNull()
    moved, promoted = F.col("new_id").isNotNull(), F.col("promoted_id") != F.col("live")
    status = (
        F.when(F.col("ambiguous"), "ambiguous").when(F.col("start").isNull(), "unresolved").when(F.coalesce("is_deleted", F.lit(False)), "deleted")
        .when(F.col("promoted_id").isNull(), "unresolved").when(promoted, "promoted").when(moved, "merged")
        .when(F.col("given_id").isNotNull() | F.col("e_sci"), "exact").otherwise("synonym")
    )
    note = F.concat_ws(
        "; ",
        F.when(moved, F.concat(F.lit("merged "), F.col("start"), F.lit(" -> "), F.col("live"))),
        F.when(F.coalesce(promoted, F.lit(False)), F.concat(F.lit("promoted "), F.col("live"), F.lit(" -> "), F.col("promoted_id"))),
    )
    answer = got.select(
        F.col("name").alias("_n"), F.col("given_id").alias("_g"), F.when(~F.col("ambiguous") & F.col("is_deleted").isNull(), F.col("promoted_id")).alias("tax_id"), status.alias("status"),
        F.when(F.col("given_id").isNull(), F.coalesce("e_name", "s_name")).alias("matched_name"), F.col("start").alias("original_tax_id"), "original_rank",
        F.coalesce(normalized, F.lit(False)).alias("normalized"), F.when(F.col("ambiguous"), ids).alias("candidates"), note.alias("note"),
    )
    return mentions.join(answer, mentions["name"].eqNullSafe(answer["_n"]) & mentions["given_id"].eqNullSafe(answer["_g"]), "left").drop("_n", "_g")


def scope(nodes: DataFrame, cited: DataFrame, roots: list[int]) -> DataFrame:
    """Ids of the descendants of the roots and of the cited taxa, with all their ancestors: what lies under a root by a range of numbers, what lies above by a sum over what is below."""
    ids = nodes.select("tax_id")
    chosen = ids.filter(F.col("tax_id").isin(roots)).unionByName(cited.select("tax_id").join(ids, "tax_id", "left_semi"))
    labels = trees.labelled(nodes.select(F.col("tax_id").alias("child"), F.col("parent_id").alias("parent")), chosen.select(F.col("tax_id").alias("node"), F.lit(1).alias("n")))
    return trees.under(labels, roots).select("node").unionByName(labels.filter("marked > 0").select("node")).distinct().withColumnRenamed("node", "tax_id")


def one_under(candidates: DataFrame, labels: DataFrame, roots: list[int]) -> DataFrame:
    """(key, tax_id): keys of which exactly one candidate (key, tax_id) stands under the roots. labels: trees.labelled of the taxonomy."""
    good = candidates.join(trees.under(labels, roots, itself=False).select(F.col("node").alias("tax_id")), "tax_id", "left_semi")
    return good.groupBy("key").agg(F.count_distinct("tax_id").alias("n"), F.min("tax_id").alias("tax_id")).filter("n = 1").select("key", "tax_id")


def route_join(asked: DataFrame, key: str, variants: str, index: DataFrame) -> DataFrame:
    """asked (key, variants array<struct<pos,kind,value[,route]>>) against index (kind, value, target): the first variant that matches wins, under its route's name (its kind, if it has none);
    the others' hits stay in `also`; none: route 'minted'."""
    named = "route" in asked.schema[variants].dataType.elementType.names
    tried = asked.select(key, F.explode_outer(variants).alias("v")).select(key, "v.pos", "v.kind", "v.value", F.col("v.route" if named else "v.kind").alias("named"))
    # a row a spelling, however many targets claim it: a variant meets one row, and hits are no more than variants
    once = index.filter("target is not null").groupBy("kind", "value").agg(F.min("target").alias("target"), F.collect_set("target").alias("targets"))
    hits = tried.join(once, ["kind", "value"])
    best = hits.groupBy(key).agg(F.min(F.struct("pos", "named", "target")).alias("m"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("targets")))).alias("every"))
    out = asked.select(key).join(best, key, "left")
    also = F.array_except("every", F.array("m.target"))
    return out.select(key, F.col("m.target").alias("target"), F.coalesce("m.named", F.lit("minted")).alias("route"), also.alias("also"))


def unique_keys(df: DataFrame, key: str, target: str) -> DataFrame:
    """(key, target) of keys that one target alone claims."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(target).alias("_n"), F.min(target).alias(target)).filter("_n = 1").drop("_n")


def deepest_paths(paths: DataFrame, group: str, path: str) -> DataFrame:
    """Paths that no longer path of their group extends; a prefix of length n is met by an equi-join on the group and the prefix itself."""
    longer = paths.select(group, F.explode(F.expr(f"transform(sequence(1, greatest(1, size({path}) - 1)), n -> slice({path}, 1, n))")).alias("_p"), F.size(path).alias("_n")).filter(F.size("_p") < F.col("_n"))
    return paths.join(longer.select(group, F.col("_p").alias(path)).distinct(), [group, path], "left_anti")


def pair_conditions(df: DataFrame, key: str, labels: str, ids: str, names: DataFrame) -> DataFrame:
    """(key, label, id, method). labels and ids are cells of comma lists. Equal counts pair in turn; else a run of label parts that joins to an id's own name pairs with it,
    then a single id takes the whole cell; what is left has no id. names: (id, name)."""
    cells = df.select(key, F.expr(f"filter(transform(split({labels}, ','), x -> trim(x)), x -> x != '')").alias("l"), F.expr(f"filter(transform(split({ids}, '[,;]'), x -> trim(x)), x -> x != '')").alias("i"), F.trim(labels).alias("whole"))
    zipped = cells.filter("size(l) = size(i)").select(key, F.explode(F.arrays_zip("l", "i")).alias("z")).select(key, F.col("z.l").alias("label"), F.col("z.i").alias("id"), F.lit("zip").alias("method"))
    rest = cells.filter("size(l) != size(i)")
    runs = rest.select(key, "i", F.explode(F.expr("flatten(transform(sequence(1, size(l)), a -> transform(sequence(a, size(l)), b -> struct(a as a, b as b, array_join(slice(l, a, b - a + 1), ', ') as label))))")).alias("r"))
    named = runs.select(key, "r", F.explode("i").alias("id")).join(names, "id").filter(casefold(F.col("r.label")) == casefold(F.col("name")))
    hits = named.groupBy(key, "id").agg(F.min("r").alias("r")).select(key, F.col("r.label").alias("label"), "id", F.lit("name run").alias("method"), F.col("r.a").alias("a"), F.col("r.b").alias("b"))
    whole = rest.filter("size(i) = 1").join(hits.select(key), key, "left_anti").select(key, F.col("whole").alias("label"), F.element_at("i", 1).alias("id"), F.lit("whole cell").alias("method"))
    taken = hits.groupBy(key).agg(F.collect_list(F.struct("a", "b")).alias("t"))
    left = rest.filter("size(i) != 1").join(taken, key, "left").select(key, F.posexplode("l").alias("p", "label"), "t")
    left = left.filter("t is null or not exists(t, x -> p + 1 between x.a and x.b)").select(key, "label", F.lit(None).cast("string").alias("id"), F.lit("unpaired").alias("method"))
    return zipped.unionByName(hits.drop("a", "b")).unionByName(whole).unionByName(left)


def curie_route(curie: Column, kinds: dict[str, str]) -> Column:
    """Node type by prefix; null for a malformed or unknown one."""
    head = F.upper(F.regexp_extract(F.replace(F.trim(curie), F.lit("_"), F.lit(":")), r"^([A-Za-z]+):\S+$", 1))
    out = F.lit(None).cast("string")
    for k, v in kinds.items():
        out = F.when(head == k, v).otherwise(out)
    return out


def disagreement(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, kind): keys of one file only, and keys whose values differ."""
    j = a.select(key, F.col(value).alias("_a"), F.lit(1).alias("_ia")).join(b.select(key, F.col(value).alias("_b"), F.lit(1).alias("_ib")), key, "full_outer")
    kind = F.when(F.col("_ib").isNull(), "left only").when(F.col("_ia").isNull(), "right only").when(~F.col("_a").eqNullSafe(F.col("_b")), "differs")
    return j.select(key, kind.alias("kind")).filter("kind is not null")


#: A rest of so many rows of three values is read in turn by one task.
SMALL_REST = 50_000


def _read_in_turn(rows: DataFrame) -> DataFrame:
    """The kept rows of a small rest (o, a, b)."""

    def run(batches):
        import pyarrow as pa

        first, second = set(), set()
        for batch in batches:
            good = []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                good.append((a is None or a not in first) and (b is None or b not in second))
                if good[-1]:
                    first.add(a)
                    second.add(b)
            yield batch.filter(pa.array(good, pa.bool_()))

    return rows.coalesce(1).sortWithinPartitions("o").mapInArrow(run, rows.schema)


def two_key_first_wins(df: DataFrame, order: str, first: str, second: str, small: int = SMALL_REST) -> DataFrame:
    """Rows kept if no earlier kept row has the same `first` or `second`, as a reader in turn would keep them; a null key conflicts with nothing. `order` is unique.

    A turn looks at the two earliest undecided rows of each key. A row that is the earliest of both its keys is kept. A row with a single earlier rival is kept if the rival is not: such rows form chains, whose ends
    and lengths are found by doubling, so a chain of any length is decided in one turn. What shares a key with a kept row goes; rows whose rivals are still open wait for the next turn. When at most `small` rows are
    left, one task reads them in turn."""
    left, kept = cut(df.select(F.col(order).alias("o"), F.col(first).alias("a"), F.col(second).alias("b"))), None
    while True:
        if left.count() <= small:
            last = _read_in_turn(left)
            kept = last if kept is None else kept.unionByName(last)
            return df.join(kept.select(F.col("o").alias(order)), order, "left_semi").select(*df.columns)
        rows = left
        for c in ("a", "b"):
            early = left.filter(F.col(c).isNotNull()).select(c, "o").withColumn("r", F.row_number().over(Window.partitionBy(c).orderBy("o"))).filter("r <= 2")  # two rows a key and task are shuffled
            rows = rows.join(early.groupBy(c).agg(F.min("o").alias(f"{c}1"), F.max("o").alias(f"{c}2")), c, "left")
        rows = rows.select("o", *[(F.col(c).isNull() | (F.col("o") == F.col(f"{c}1"))).alias(f"{c}_free") for c in "ab"], *[F.when(F.col("o") == F.col(f"{c}2"), F.col(f"{c}1")).alias(f"{c}_rival") for c in "ab"])
        rival = F.when(F.col("a_free") & ~F.col("b_free"), F.col("b_rival")).when(~F.col("a_free") & F.col("b_free"), F.col("a_rival")).when(~F.col("a_free") & ~F.col("b_free") & (F.col("a_rival") == F.col("b_rival")), F.col("a_rival"))
        rows = cut(rows.select(F.col("o").alias("node"), rival.alias("up"), (F.col("a_free") & F.col("b_free")).alias("kept"), F.when(rival.isNull(), 0).otherwise(1).alias("far")))
        chains = trees.folded(rows, {"kept": lambda near, far: far, "far": lambda near, far: near + far})
        now = cut(left.join(chains.filter("kept and far % 2 = 0").select(F.col("node").alias("o")), "o", "left_semi"))
        kept = now if kept is None else kept.unionByName(now)
        left = left.join(now.select("o"), "o", "left_anti").join(now.select("a").filter("a is not null"), "a", "left_anti").join(now.select("b").filter("b is not null"), "b", "left_anti")
        left = cut(left.select("o", "a", "b"))
