"""Join policies of the sources: who wins, what is refused, and where refusals are kept (D13, D15-D17, D19-D22, D29-D38, C17, X7-X9). Each is a join or an aggregate; ledgers are frames beside the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .reconcile import RANKS, casefold, rank_depth, two_key_first_wins, unique_keys
from .rules import join_key, lookup

#: Marks of a rank before a reported name (fixed values).
RANK_MARKS = {"k__": "kingdom", "p__": "phylum", "c__": "class", "o__": "order", "f__": "family", "g__": "genus", "s__": "species", "t__": "strain"}
#: Synonyms of a taxon that are shown.
SHOWN_SYNONYMS = 20


def taxon_rows(nodes: DataFrame, names: DataFrame, most: int = SHOWN_SYNONYMS) -> DataFrame:
    """(tax_id, name, rank, parent_id, synonyms, n_synonyms, synonyms_text): the first `most` synonyms in order of the file (names: tax_id, name, name_class, seq) and their true number.
    A parent that is the taxon itself or no taxon is null (D13)."""
    sci = names.filter("name_class = 'scientific name'").groupBy("tax_id").agg(F.min_by("name", "seq").alias("name"))
    other = names.filter("name_class != 'scientific name'").join(sci.withColumnRenamed("name", "sci"), "tax_id", "left").filter(~F.col("name").eqNullSafe(F.col("sci")))
    once = other.groupBy("tax_id", "name").agg(F.min("seq").alias("seq"))
    place = F.row_number().over(Window.partitionBy("tax_id").orderBy("seq", "name"))
    top = once.withColumn("at", place).groupBy("tax_id").agg(F.count(F.lit(1)).alias("n_synonyms"), F.array_sort(F.collect_list(F.when(F.col("at") <= most, F.struct("at", "name")))).alias("s"))
    top = top.select("tax_id", "n_synonyms", F.transform("s", lambda x: x["name"]).alias("synonyms"))
    parents = nodes.select(F.col("tax_id").alias("parent_id"), F.lit(True).alias("held"))
    rows = nodes.join(sci, "tax_id", "left").join(top, "tax_id", "left").join(parents, "parent_id", "left")
    parent = F.when(F.col("held") & (F.col("parent_id") != F.col("tax_id")), F.col("parent_id"))
    return rows.select("tax_id", "name", "rank", parent.alias("parent_id"), "synonyms", F.coalesce("n_synonyms", F.lit(0)).alias("n_synonyms"), F.array_join("synonyms", "; ").alias("synonyms_text"))


def under_ceiling(df: DataFrame, rank: str, ceiling: str) -> tuple[DataFrame, DataFrame]:
    """(rows at or below the rank, refused rows with a reason): a rank off the ladder is refused too."""
    depth, top = rank_depth(F.col(rank)), RANKS.index(ceiling) + 1
    good = F.coalesce(depth >= top, F.lit(False))
    reason = F.concat(F.lit("rank "), F.coalesce(F.col(rank), F.lit("none")), F.lit(f" is above {ceiling} or off the ladder"))
    return df.filter(good), df.filter(~good).withColumn("reason", reason)


def deeper_claim_wins(claims: DataFrame, group: str, target: str, path: str, exact: str) -> DataFrame:
    """One claim for each (group, target): the deepest path, then one spelled exactly, then the path in order."""
    best = F.min(F.struct((-F.size(path)).alias("_d"), (~F.col(exact)).alias("_e"), F.col(path).alias("_p"), F.struct("*").alias("_row"))).alias("m")
    return claims.groupBy(F.col(group).alias("_g"), F.col(target).alias("_t")).agg(best).select("m._row.*")


def first_target(pairs: DataFrame, key: str, target: str, order: str) -> DataFrame:
    """(key, target): the first writer of a key wins."""
    return pairs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(target, F.struct(order, target)).alias(target))


def hub(ids: DataFrame, key: str, terms: DataFrame) -> DataFrame:
    """(key, hub_id, hub_name) of term ids: a live id of the hub is itself; another is the term that declares it equivalent, the first of several; an obsolete or unknown hub id is none.
    terms: id, name, obsolete, equivalents."""
    live = terms.filter("not obsolete and name is not null").select(F.upper("id").alias("hub_id"), F.col("name").alias("hub_name"), "equivalents", F.col("id").alias("_o"))
    same = first_target(live.select(F.explode("equivalents").alias("x"), "hub_id", "_o").select(F.upper("x").alias("_n"), F.col("hub_id").alias("e_id"), "_o"), "_n", "e_id", "_o")
    asked = ids.select(key).distinct().withColumn("_n", F.upper(F.replace(F.trim(key), F.lit("_"), F.lit(":"))))
    got = asked.join(live.select(F.col("hub_id").alias("_n"), F.col("hub_id").alias("own")), "_n", "left").join(same, "_n", "left")
    of_hub = F.substring_index("_n", ":", 1) == F.lit(_prefix_of(terms))
    got = got.withColumn("hub_id", F.coalesce("own", F.when(~of_hub, F.col("e_id"))))
    return got.join(live.select("hub_id", "hub_name"), "hub_id", "left").select(key, "hub_id", "hub_name")


def _prefix_of(terms: DataFrame) -> str:
    """The hub's own vocabulary: the prefix of its first id."""
    row = terms.agg(F.min(F.upper(F.substring_index("id", ":", 1)))).first()
    return row[0] or ""


def by_name(labels: DataFrame, key: str, terms: DataFrame, normal=casefold) -> DataFrame:
    """(key, hub_id, route) of labels: a live term's name, else an exact synonym of one term alone that is no term's name; else `unmatched`."""
    live = terms.filter("not obsolete and name is not null")
    names = live.groupBy(casefold(F.trim("name")).alias("_k")).agg(F.min("id").alias("by_name"))
    spoken = unique_keys(live.select(F.explode("exact_synonyms").alias("s"), "id").select(casefold(F.trim("s")).alias("_k"), "id"), "_k", "id").withColumnRenamed("id", "by_synonym")
    spoken = spoken.join(names, "_k", "left_anti")
    asked = labels.select(key).distinct().withColumn("_k", normal(F.trim(key)))
    got = asked.join(names, "_k", "left").join(spoken, "_k", "left")
    route = F.when(F.col("by_name").isNotNull(), "mondo-name").when(F.col("by_synonym").isNotNull(), "mondo-exact-synonym").otherwise("unmatched")
    return got.select(key, F.coalesce("by_name", "by_synonym").alias("hub_id"), route.alias("route"))


def reported_taxa(df: DataFrame, key: str, names: str, ids: str) -> DataFrame:
    """(key, at, name, reported_rank, tax_id) of two cells: names parted by commas, ids by semicolons, each a lineage of which the last counts. Where their numbers differ the ids win and stand
    without names; without ids the names stand alone (D22)."""
    parts = lambda c, sep: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")
    cells = df.select(F.col(key), parts(names, ",").alias("n"), parts(ids, ";").alias("i"))
    n = F.when((F.size("i") == 0) | (F.size("n") == F.size("i")), F.col("n")).otherwise(F.array().cast("array<string>"))
    rows = cells.select(key, F.posexplode(F.arrays_zip(n.alias("n"), F.col("i").alias("i"))).alias("at", "z"))
    last = lambda c: F.trim(F.element_at(F.split(c, r"\|"), -1))
    name = last(F.col("z.n"))
    rank = lookup(F.substring(name, 1, 3), RANK_MARKS)
    bare = F.when(rank.isNotNull(), F.substr(name, F.lit(4))).otherwise(name)
    return rows.select(key, "at", bare.alias("name"), rank.alias("reported_rank"), last(F.col("z.i")).try_cast("bigint").alias("tax_id"))


def already_held(records: DataFrame, order: str, held: DataFrame, own: str, source: str) -> tuple[DataFrame, DataFrame]:
    """(new records, held ones with holder and route). A record is held by accession, then by structure key, then by name, against rows other sources wrote; a record that an earlier new one
    has by name or structure is held by it (D29). records: order, accession, inchikey, name; held: id, accessions, inchikey, name and the owner column."""
    other = held.filter(~F.col(own).eqNullSafe(F.lit(source)))

    def index(column: Column, kind: str) -> DataFrame:
        return other.select(F.explode(column).alias(kind), "id").filter(F.col(kind).isNotNull() & (F.col(kind) != "")).groupBy(kind).agg(F.min("id").alias(f"h_{kind}"))

    got = records.withColumn("_name", casefold(F.trim("name")))
    got = got.join(index(F.col("accessions"), "accession"), "accession", "left").join(index(F.array("inchikey"), "inchikey"), "inchikey", "left")
    got = got.join(index(F.array(casefold(F.trim("name"))), "_name"), "_name", "left")
    holder = F.coalesce("h_accession", "h_inchikey", "h__name")
    route = F.when(F.col("h_accession").isNotNull(), "accession").when(F.col("h_inchikey").isNotNull(), "inchikey").when(F.col("h__name").isNotNull(), "name")
    got = got.withColumn("holder", holder).withColumn("route", route).drop("h_accession", "h_inchikey", "h__name")
    free = got.filter("holder is null").drop("holder", "route")
    new = two_key_first_wins(free, order, "_name", "inchikey")
    later = free.join(new.select(order), order, "left_anti").withColumn("holder", F.lit(None).cast("string")).withColumn("route", F.lit("earlier record"))
    return new.drop("_name"), got.filter("holder is not null").unionByName(later, allowMissingColumns=True).drop("_name")


def wanted_names(compounds: DataFrame, key: str, variants: str, held: DataFrame, name: str) -> DataFrame:
    """(key, value): all spellings of compounds of which no spelling is held yet (D30). variants: array<struct<value>>."""
    tried = compounds.select(key, F.explode(variants).alias("v")).select(key, "v.value")
    known = tried.join(held.select(casefold(F.trim(name)).alias("value")).distinct(), "value", "left_semi").select(key).distinct()
    return tried.join(known, key, "left_anti").select(key, "value").distinct()


def collapse_to_parents(molecules: DataFrame, mechanisms: DataFrame) -> DataFrame:
    """(drug_id, members, props): molecules and ids that only mechanisms name, by their parent; properties are those of the parent's own record, else of the first member that has one.
    molecules: molecule_id, props; mechanisms: molecule_id, parent_id."""
    parents = mechanisms.filter("parent_id is not null and parent_id != molecule_id").groupBy("molecule_id").agg(F.min("parent_id").alias("parent_id"))
    ids = molecules.select("molecule_id").unionByName(mechanisms.select("molecule_id")).unionByName(mechanisms.filter("parent_id is not null").select(F.col("parent_id").alias("molecule_id"))).distinct()
    rows = ids.join(parents, "molecule_id", "left").join(molecules, "molecule_id", "left").withColumn("drug_id", F.coalesce("parent_id", "molecule_id"))
    rank = F.when(F.col("props").isNull(), 2).when(F.col("molecule_id") == F.col("drug_id"), 0).otherwise(1)
    return rows.groupBy("drug_id").agg(F.array_sort(F.collect_set("molecule_id")).alias("members"), F.min_by("props", F.struct(rank, F.col("molecule_id"))).alias("props"))


def link_by_label(rows: DataFrame, key: str, label: str, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, ledger) of whole labels against index (name, target): exact when folded, of names that one target has. The ledger names the parts of a comma label that would match."""
    names = unique_keys(index.select(casefold(F.trim("name")).alias("_k"), "target"), "_k", "target")
    asked = rows.select(key, label, casefold(F.trim(label)).alias("_k"))
    links = asked.join(names, "_k").select(key, label, "target")
    missed = asked.join(names, "_k", "left_anti")
    parts = missed.select(key, F.posexplode(F.split(label, ",")).alias("at", "p")).select(key, "at", casefold(F.trim("p")).alias("_k"))
    near = parts.join(names, "_k").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "target"))).alias("n"))
    ledger = missed.join(near, key, "left").select(
        key, label, F.array_join(F.transform("n", lambda x: x["target"].cast("string")), "|").alias("detail"),
        F.when(F.col("n").isNotNull() & F.contains(F.col(label), F.lit(",")), "several names in one label").otherwise("no exact name").alias("reason"),
    )
    return links, ledger


def join_by_id(mapping: DataFrame, id_column: str, index: DataFrame, target: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(links, misses): mapping rows with the first target of their id; ids without one by the number of rows that cite them."""
    got = mapping.join(first_target(index, id_column, target, order), id_column, "left")
    misses = got.filter(F.col(target).isNull()).groupBy(id_column).agg(F.count(F.lit(1)).alias("n_rows"))
    return got.filter(F.col(target).isNotNull()), misses


def mint_missing(declared: DataFrame, mapping: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label, minted): the list, and what only mapping rows name, under the least label they give."""
    extra = mapping.join(declared.select(key), key, "left_anti").groupBy(key).agg(F.min(label).alias(label))
    return declared.select(key, label).withColumn("minted", F.lit(False)).unionByName(extra.withColumn("minted", F.lit(True)))


def undeclared_ends(hierarchy: DataFrame, ends: tuple[str, str], declared: DataFrame, key: str) -> DataFrame:
    """(key, n): endpoints of a hierarchy that the list does not declare, with their rows."""
    both = hierarchy.select(F.explode(F.array(*ends)).alias(key))
    return both.join(declared.select(key), key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def match_columns(columns: DataFrame, label: str, dictionary: DataFrame, collection: str, name: str, fixes: dict[str, str] | None = None) -> DataFrame:
    """columns with the dictionary's `entry` and the route: by collection number, by a name that one entry has, or by a correction; none: null (D35). dictionary: entry, collection, name."""
    asked = columns.withColumn("_k", join_key(F.col(label)))
    asked = asked.withColumn("_fixed", F.coalesce(lookup(F.col("_k"), fixes or {}), F.col("_k")))
    numbers = unique_keys(dictionary.select(join_key(F.col(collection)).alias("_c"), "entry").filter("_c != ''"), "_c", "entry").withColumnRenamed("entry", "by_number")
    names = unique_keys(dictionary.select(join_key(F.col(name)).alias("_c"), "entry").filter("_c != ''"), "_c", "entry").withColumnRenamed("entry", "by_name")
    got = asked.join(numbers.withColumnRenamed("_c", "_k"), "_k", "left").join(names.withColumnRenamed("_c", "_fixed"), "_fixed", "left")
    route = F.when(F.col("by_number").isNotNull(), "collection").when(F.col("by_name").isNotNull(), F.when(F.col("_fixed") != F.col("_k"), "override").otherwise("name"))
    return got.withColumn("route", route).withColumn("entry", F.coalesce("by_number", "by_name")).drop("_k", "_fixed", "by_number", "by_name")


def one_column_each(genes: DataFrame, key: str, columns: DataFrame) -> DataFrame:
    """genes (key, tax_id, strain_key) with the one column (label, tax_id, reference_key) of their taxon whose reference the strain's name holds; any other number of hits is a reason."""
    hits = genes.select(key, "tax_id", "strain_key").join(columns.filter("reference_key is not null and reference_key != ''"), "tax_id").filter(F.contains("strain_key", "reference_key"))
    n = hits.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("label"))
    got = genes.join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return got.withColumn("label", F.when(F.col("n") == 1, F.col("label"))).withColumn("reason", F.when(F.col("n") != 1, F.concat(F.lit("matches "), F.col("n"), F.lit(" columns")))).drop("n")


def routed_taxon(own: Column, dictionary: Column, genus: Column) -> Column:
    """struct(tax_id, route, note): the record's id, else the dictionary's, else its genus; a note where the first two differ."""
    number = lambda c: F.when(F.trim(c).rlike(r"^\d+$"), F.trim(c).try_cast("bigint"))
    a, b, g = number(own.cast("string")), number(dictionary.cast("string")), number(genus.cast("string"))
    route = F.when(a.isNotNull(), "record").when(b.isNotNull(), "dictionary").when(g.isNotNull(), "genus").otherwise("none")
    note = F.when(a.isNotNull() & b.isNotNull() & (a != b), F.concat(F.lit("the record says "), a.cast("string"), F.lit(", the dictionary "), b.cast("string")))
    return F.struct(F.coalesce(a, b, g).alias("tax_id"), route.alias("route"), note.alias("note"))


def also_measured(rows: DataFrame, pair: list[str], layers: dict[str, DataFrame]) -> DataFrame:
    """rows with `also_measured`: the sorted names of the layers that hold the same pair; none: null."""
    parts = [df.select(*pair, F.lit(name).alias("_layer")) for name, df in layers.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return rows.join(every.groupBy(*pair).agg(F.array_sort(F.collect_set("_layer")).alias("also_measured")), pair, "left")


def hit_counts(nodes: DataFrame, key: str, edges: DataFrame, column: str, name: str) -> DataFrame:
    """nodes with the number of edges that cite them, 0 where none does (C17)."""
    n = edges.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias(name))
    return nodes.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def status_histogram(resolved: DataFrame, status: str = "status") -> DataFrame:
    """How many rows got each status: a report that writes no rows of its own."""
    return resolved.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def cited_ids(cited: DataFrame, notes: DataFrame, key: str) -> DataFrame:
    """Cited ids that are digits, once each, with their notes if any."""
    ids = cited.filter(F.col(key).cast("string").rlike(r"^\d+$")).select(F.col(key).cast("bigint").alias(key)).distinct()
    return ids.join(notes, key, "left")
