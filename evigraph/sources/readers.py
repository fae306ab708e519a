"""Readers of the raw forms: separator dumps, OBO, JSON by id, JSON lines, XML records, TSV, workbooks, wide matrices."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.rules import direction


class MissingInput(FileNotFoundError):
    """A source's input is absent: the source is skipped, the build goes on."""


class MalformedInput(MissingInput):
    """The input is there but not what it should be: the source is skipped with the reason."""


def unreproduced(got: DataFrame, told: DataFrame, key: str, column: str) -> DataFrame:
    """(key, got, told) of every key whose number is not the one the source tells, or that only one of them has."""
    both = got.select(key, F.col(column).alias("got")).join(told.select(key, F.col(column).alias("told")), key, "full_outer")
    return both.filter(~F.col("got").eqNullSafe(F.col("told"))).select(key, "got", "told")


def reproduces(got: DataFrame, told: DataFrame, key: str, column: str) -> DataFrame:
    """got, if it has for every key the number that the source tells (a sheet's own count, a headline); else the source is malformed."""
    bad = unreproduced(got, told, key, column).orderBy(key).limit(5).collect()
    if bad:
        raise MalformedInput("; ".join(f"{r[key]}: {r['got']}, told {r['told']}" for r in bad))
    return got


def locate(root: str, *layouts: str) -> str:
    for x in layouts:
        if os.path.exists(p := os.path.join(root, x)):
            return p
    raise MissingInput(f"none of {', '.join(layouts)} under {root}")


def dump(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Fields between TAB | TAB, trimmed; blank and short lines are skipped."""
    cells = F.transform(F.split(F.regexp_replace("value", r"\t?\|?\s*$", ""), r"\t\|\t"), lambda x: F.trim(x))
    rows = spark.read.text(path).filter("trim(value) != ''").select(cells.alias("c")).filter(F.size("c") >= len(columns))
    return rows.select(*[F.get("c", F.lit(i)).alias(name) for i, name in enumerate(columns)])


def whole_numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Columns as long; rows where one is no whole number are skipped."""
    out = df.withColumns({c: F.col(c).try_cast("bigint") for c in columns})
    for c in columns:
        out = out.filter(F.col(c).isNotNull())
    return out


def tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Tab-separated text, with a header or with given columns; short lines are skipped then."""
    if columns is None:
        return spark.read.csv(path, sep="\t", header=True, quote="")
    cells = F.split("value", "\t")
    return spark.read.text(path).select(cells.alias("c")).filter(F.size("c") >= len(columns)).select(*[F.trim(F.get("c", F.lit(i))).alias(n) for i, n in enumerate(columns)])


def banner_csv(spark: SparkSession, path: str, null_value: str | None = None, limit: int | None = None) -> DataFrame:
    """CSV whose first line may be a # banner; cells of any length. Only the banner is dropped: a data row that starts with # stays."""
    first = spark.read.text(path).limit(1).collect()
    options = dict(multiLine=True, escape='"', nullValue=null_value, maxCharsPerColumn=-1)
    if first and first[0][0].startswith("#"):
        head = spark.read.csv(path, header=False, comment="#", **options).limit(1).collect()[0]
        names = [str(c) for c in head if c is not None]
        rows = spark.read.csv(path, header=False, schema=", ".join(f"`{n}` string" for n in names), enforceSchema=True, **options)
        same = F.lit(True)
        for n in names:
            same = same & F.col(f"`{n}`").eqNullSafe(F.lit(n))
        df = rows.filter(~same & ~F.coalesce(F.col(f"`{names[0]}`") == F.lit(first[0][0].split(",")[0]), F.lit(False)))
    else:
        df = spark.read.csv(path, header=True, **options)
    return df if limit is None else df.limit(limit)


def release(df: DataFrame, releases: dict[str, list[str]]) -> str:
    """The release whose columns the table has, the one that asks for most first (A4)."""
    for name, columns in sorted(releases.items(), key=lambda kv: -len(kv[1])):
        if set(columns) <= set(df.columns):
            return name
    raise MalformedInput(f"columns of no known release: {', '.join(df.columns)}")


def taxdump(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """nodes and names, and merged and deleted if they are there: short lines and ids that are no numbers are skipped (A2)."""
    def read(name: str, columns: list[str], numbers: list[str], needed: bool = True):
        try:
            return whole_numbers(dump(spark, f"{folder}/{name}.dmp", columns), *numbers)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            if needed:
                raise MissingInput(f"{name}.dmp under {folder}") from e
            return spark.createDataFrame([], ", ".join(f"{c} bigint" for c in columns))

    names = read("names", ["tax_id", "name", "unique_name", "name_class"], ["tax_id"])
    return {
        "nodes": read("nodes", ["tax_id", "parent_id", "rank"], ["tax_id", "parent_id"]),
        "names": names.withColumn("seq", F.monotonically_increasing_id()),
        "merged": read("merged", ["old_id", "new_id"], ["old_id", "new_id"], needed=False),
        "deleted": read("delnodes", ["tax_id"], ["tax_id"], needed=False),
    }


def tree_paths(xml: Column) -> Column:
    """array<array<string>>: every root-to-node path of the term trees in a raw element, a node before what is below it (A11). Trees of any depth: the element is read as text, tag by tag, with a stack of open nodes. A
    node's term stands before its descendants; a node without a term gives no path of its own; null gives none."""

    def paths(texts):
        import re

        import pandas as pd

        tags = re.compile(r"<(/?)(root|term|descendant)(?:\s[^<>]*?)?(/?)>")
        out = []
        for text in texts:
            found, stack, done = [], [], 0
            for m in tags.finditer(text or ""):
                closes, name, empty = m.groups()
                if m.start() < done or empty:
                    continue
                if name != "term":
                    if not closes:
                        stack.append(None)
                    elif stack:
                        stack.pop()
                elif not closes and stack and stack[-1] is None:
                    done = text.find("</term>", m.end())
                    done = len(text) if done < 0 else done
                    stack[-1] = text[m.end() : done]
                    found.append([x for x in stack if x is not None])
            out.append(found)
        return pd.Series(out)

    return F.pandas_udf(paths, "array<array<string>>")(xml)


def flagged_columns(df: DataFrame, key: str, header: dict[str, str], kind: str) -> DataFrame:
    """(key, labels): of the columns whose sub-heading is `kind`, the labels of those whose cell is 1 (A16). header: column -> sub-heading."""
    wide = [c for c, k in header.items() if k == kind and c in df.columns]
    if not wide:
        raise MalformedInput(f"no {kind!r} column")
    cells = df.select(key, *wide).unpivot([key], wide, "label", "cell").filter(F.col("cell").cast("double") == 1)
    return df.select(key).distinct().join(cells.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("labels")), key, "left").withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


def claims(df: DataFrame, columns: dict[str, str], keep: Column | None = None) -> DataFrame:
    """A reference set as (microbe, disease, direction, and any other named column), distinct; directions in this graph's words (A20). columns: our name -> theirs."""
    rows = (df if keep is None else df.filter(keep)).select(*[F.trim(F.col(theirs).cast("string")).alias(ours) for ours, theirs in columns.items()])
    rows = rows.withColumn("direction", direction(F.col("direction")))
    return rows.filter("microbe != '' and disease != ''").distinct()


def id_bridge(df: DataFrame, column: str) -> DataFrame:
    """The distinct ids of a column: the small side of a semi-join."""
    return df.select(F.trim(column).alias("id")).filter("id != ''").distinct()


def json_by_id(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(id, value) of one big JSON object; keys that start with _ are about the file."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("id", "json"))
    return whole.filter(~F.col("id").startswith("_")).select("id", F.from_json("json", value).alias("value"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def xml_records(spark: SparkSession, path: str, tag: str, schema: str | None = None) -> DataFrame:
    """One row for each record element, read in splits."""
    reader = spark.read.format("xml").option("rowTag", tag)
    return (reader.schema(schema) if schema else reader).load(path)


def obo(spark: SparkSession, path: str) -> DataFrame:
    """(id, tags map<string, array<string>>) of [Term] stanzas; a stanza is a record of its own, split at blank lines."""
    stanza = spark.read.text(path, lineSep="\n\n").filter(F.trim("value").startswith("[Term]")).withColumn("n", F.monotonically_increasing_id())
    lines = stanza.select("n", F.posexplode(F.split("value", r"\r?\n")).alias("p", "line"))
    pairs = lines.select("n", "p", F.regexp_extract("line", r"^([A-Za-z_-]+):\s*(.*)$", 1).alias("tag"), F.trim(F.regexp_extract("line", r"^([A-Za-z_-]+):\s*(.*)$", 2)).alias("text")).filter("tag != ''")
    by_tag = pairs.groupBy("n", "tag").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "text"))), lambda x: x["text"]).alias("texts"))
    tags = by_tag.groupBy("n").agg(F.map_from_entries(F.collect_list(F.struct("tag", "texts"))).alias("tags"))
    return tags.select(F.try_element_at("tags", F.lit("id"))[0].alias("id"), "tags")


def disease_terms(terms: DataFrame) -> DataFrame:
    """(id, name, obsolete, exact_synonyms, equivalents) of an ontology's stanzas."""

    def of(tag: str):
        return F.coalesce(F.try_element_at("tags", F.lit(tag)), F.array().cast("array<string>"))

    exact = F.transform(F.filter(of("synonym"), lambda s: s.rlike(r'^"[^"]*"\s+EXACT')), lambda s: F.regexp_extract(s, r'^"([^"]*)"', 1))
    same = F.transform(F.filter(of("xref"), lambda s: s.contains("equivalentTo")), lambda s: F.regexp_extract(s, r"^(\S+)", 1))
    return terms.select("id", F.try_element_at(of("name"), F.lit(1)).alias("name"), F.array_contains(of("is_obsolete"), "true").alias("obsolete"), exact.alias("exact_synonyms"), same.alias("equivalents"))


def unpivot_matrix(df: DataFrame, ids: list[str], pattern: str, name: str = "column", value: str = "cell") -> DataFrame:
    """A wide matrix as cells; its columns are those whose header matches."""
    import re

    wide = [c for c in df.columns if re.search(pattern, c)]
    return df.unpivot(ids, wide, name, value)


class WorkbookSource(DataSource):
    """spark.read.format("evigraph_xlsx"): rows of a named sheet as (row, cells array<string>), with the standard library alone. Absent cells are null."""

    @classmethod
    def name(cls) -> str:
        return "evigraph_xlsx"

    def schema(self) -> str:
        return "row int, cells array<string>"

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader(self.options)


class WorkbookReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.sheet = options["path"], options.get("sheet")

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        import re
        import zipfile
        from xml.etree import ElementTree as ET

        local = lambda e: e.tag.rsplit("}", 1)[-1]
        with zipfile.ZipFile(self.path) as z:
            shared: list[str] = []
            if "xl/sharedStrings.xml" in z.namelist():
                with z.open("xl/sharedStrings.xml") as f:
                    for _, e in ET.iterparse(f):
                        if local(e) == "si":
                            shared.append("".join(t.text or "" for t in e.iter() if local(t) == "t"))
                            e.clear()
            book = ET.fromstring(z.read("xl/workbook.xml"))
            links = {e.get("Id"): e.get("Target") for e in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
            sheets = {e.get("name"): next(v for k, v in e.attrib.items() if k.endswith("}id")) for e in book.iter() if local(e) == "sheet"}
            target = links[sheets[self.sheet] if self.sheet else next(iter(sheets.values()))].lstrip("/")
            with z.open(target if target.startswith("xl/") else f"xl/{target}") as f:
                n = 0
                for _, e in ET.iterparse(f):
                    if local(e) != "row":
                        continue
                    n = int(e.get("r") or n + 1)
                    cells: list[str | None] = []
                    for c in e:
                        ref = re.match(r"[A-Z]+", c.get("r") or "")
                        at = 0
                        for ch in ref[0] if ref else "":
                            at = at * 26 + ord(ch) - 64
                        cells += [None] * ((at or len(cells) + 1) - len(cells))
                        if c.get("t") == "inlineStr":
                            text = "".join(t.text or "" for t in c.iter() if local(t) == "t")
                        else:
                            text = next((v.text for v in c if local(v) == "v"), None)
                            if c.get("t") == "s" and text is not None:
                                text = shared[int(text)]
                        cells[(at or len(cells)) - 1] = text
                    e.clear()
                    yield n, cells


def workbook(spark: SparkSession, path: str, sheet: str | None = None, header: str | None = None, subheader: dict[str, str] | None = None, skip: str | None = None) -> DataFrame:
    """Rows under the first row that holds the header cell, by its names; all text. Without a header: (row, cells). subheader: name -> what the row under the header must hold
    there, else the book is malformed; skip: a column without which a row is a sub-heading and goes. The path is one that the executors can open: a shared folder on a cluster."""
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("evigraph_xlsx").option("path", path)
    rows = (reader.option("sheet", sheet) if sheet else reader).load()
    if header is None:
        return rows
    top = rows.filter(F.array_contains("cells", header)).orderBy("row").limit(1).collect()
    if not top:
        raise MalformedInput(f"{path}: no row with {header!r}")
    names = [(i, n.strip()) for i, n in enumerate(top[0]["cells"]) if n and n.strip()]
    first = top[0]["row"]
    if subheader:
        under = rows.filter(F.col("row") == first + 1).limit(1).collect()
        place = {n: i for i, n in names}
        for name, want in subheader.items():
            got = under[0]["cells"][place[name]] if under and name in place and place[name] < len(under[0]["cells"]) else None
            if got != want:
                raise MalformedInput(f"{path}: {name!r} stands over {got!r}, not {want!r}")
        first += 1
    out = rows.filter(F.col("row") > first).select(*[F.get("cells", F.lit(i)).alias(n) for i, n in names])
    return out if skip is None else out.filter(F.col(f"`{skip}`").isNotNull() & (F.trim(F.col(f"`{skip}`")) != ""))
