"""Markdown trees: root/<category>/<type>/[<sub>/]*.md to documents with sections and tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import TITLE_TERMS, language

SECTION = "struct<section_id:string,section_type:string,title:string,content:string,level:int,parent_section:string,tags:array<string>>"
TABLE = "struct<headers:array<string>,rows:array<array<string>>,total_rows:int>"


def category(folder: Column) -> Column:
    """The name in brackets after "Documents", else what stands before the first dash, else the folder's name."""
    inner = F.regexp_extract(folder, r"Documents \(([^)]+)\)", 1)
    plain = F.trim(F.regexp_extract(folder, r"^([^-]+)", 1))
    return F.coalesce(F.nullif(inner, F.lit("")), F.nullif(plain, F.lit("")), folder)


def scan(spark: SparkSession, root: str) -> DataFrame:
    """One row per file at the third or fourth level, with its metadata; newlines are made one character."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rel = F.split(F.substring_index("path", root.rstrip("/") + "/", -1), "/")
    n = F.size(rel)
    ok = ((n == 3) & F.lower(rel[2]).endswith(".md")) | ((n == 4) & F.element_at(rel, -1).endswith(".md"))
    # a file that isn't UTF-8 has no content, and is set aside when it is parsed
    text = F.regexp_replace(F.try_validate_utf8(F.col("content").cast("string")), "\r\n?", "\n")
    rows = files.where(ok).select(
        category(rel[0]).alias("chip_category"), rel[1].alias("document_type"), F.when(n == 4, rel[2]).alias("sub_category"), F.element_at(rel, -1).alias("file_name"),
        F.array_join(rel, "/").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("created_time"), text.alias("content"),
    )
    return rows.withColumn("content_hash", F.md5("content")).withColumn("language", language(F.col("content")))


def _table(lines: list[str]) -> dict | None:
    framed = lambda x: x.strip().startswith("|") and x.strip().endswith("|")
    if len(lines) < 2 or not framed(lines[0]):
        return None
    head = [c.strip() for c in lines[0].strip()[1:-1].split("|")]
    rows = [r for x in lines[2:] if framed(x) and len(r := [c.strip() for c in x.strip()[1:-1].split("|")]) == len(head)]
    return {"headers": head, "rows": rows, "total_rows": len(rows)}


def parse(content: str, own_tags: list[str], prefix: str) -> dict:
    """Sections (in order of completion), tables, keywords and summary of a document."""
    lines = content.split("\n")
    sections, tables, keywords = [], [], []
    header = None
    body: list[str] = []
    count = 0

    def section(kind, title, text, level=None):
        nonlocal count
        tags = own_tags + [t for t in TITLE_TERMS if title and t.lower() in title.lower()]
        count += 1
        return {"section_id": f"{prefix}_{count}", "section_type": kind, "title": title, "content": text, "level": level, "parent_section": None, "tags": tags}

    def close():
        if header and body:
            header["content"] = "\n".join(body)
            sections.append(header)

    i = 0
    while i < len(lines):
        line = lines[i].strip()
        if line.startswith("#"):
            close()
            level = len(line) - len(line.lstrip("#"))
            title = line.lstrip("#").strip()
            header, body = section("header", title, "", level), []
            keywords.append(title)
        elif line.count("|") >= 2:
            block = [line]
            while i + 1 < len(lines) and ("|" in lines[i + 1] or not lines[i + 1].strip()):
                i += 1
                if lines[i].strip():
                    block.append(lines[i])
            if t := _table(block):
                tables.append(t)
                keywords += [c for r in [t["headers"], *t["rows"]] for c in r if len(c) < 50]
                sections.append(section("table", f"表格 {len(tables)}", "\n".join(block)))
        elif line[:1] in ("-", "*", "+") and line:
            block = [line]
            while i + 1 < len(lines) and (not lines[i + 1].strip() or lines[i + 1][0] in " \t-*+"):
                i += 1
                if lines[i].strip():
                    block.append(lines[i])
            sections.append(section("list", None, "\n".join(block)))
        elif line.startswith("```"):
            end = next((k for k in range(i + 1, len(lines)) if lines[k].strip().startswith("```")), None)
            if end is None:
                break
            sections.append(section("code", None, "\n".join(lines[i + 1 : end])))
            i = end
        elif line:
            body.append(line)
        i += 1
    close()
    parts = [s["content"][:200] for s in sections[:3] if s["section_type"] == "header" and s["content"]]
    summary = " ".join(parts)
    return {"sections": sections, "tables": tables, "keywords": list(dict.fromkeys(keywords))[:20], "summary": summary[:500] + "..." if len(summary) > 500 else summary, "images": []}


def documents(files: DataFrame) -> DataFrame:
    """scan()'s rows parsed; a row that can't be parsed has its error and no sections."""
    names = [c for c in files.columns if c != "content"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema if f.name != "content")
    schema += f", sections array<{SECTION}>, tables array<{TABLE}>, keywords array<string>, summary string, images array<string>, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                row = {k: r[k] for k in names}
                try:
                    if r["content"] is None:
                        raise ValueError("not UTF-8")
                    tags = [x for x in (r["chip_category"], r["document_type"], r["sub_category"]) if x]
                    row |= parse(r["content"], tags, r["chip_category"]) | {"error": None}
                except Exception as e:  # a bad file is set aside, not the whole scan
                    row |= {"sections": None, "tables": None, "keywords": None, "summary": None, "images": None, "error": str(e)}
                out.append(row)
            yield pd.DataFrame(out)

    return files.mapInPandas(run, schema)
