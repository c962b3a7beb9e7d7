"""CSV files that each carry their own header row, maybe below a preamble.

The files are put together by their header: all files with the same titles are one read,
whose rows pick their cells by the positions of those titles. So no row has to look up the
layout of its file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import fold_accents, normalize_name
from ..operators.schema import union_all
from .files import length

# A dataset that Spark wrote is a folder; its name is the file's name then.
FILE = r"([^/=]+?)(?:/part-[^/]*)?$"
PLACE = ("caminho", "arquivo", "_bloco", "_linha")


def _plain(cell: Column) -> Column:
    return F.btrim(F.regexp_replace(fold_accents(cell), "[^a-z0-9]+", "_"), F.lit("_"))


def decoded(address: Column) -> Column:
    """A file name without the escapes of its address; a plus sign is no escape there."""
    return F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))


def _placed(frame: DataFrame, *cols: Column) -> DataFrame:
    address = F.col("_metadata.file_path")
    return frame.select(
        address.alias("caminho"),
        decoded(F.regexp_extract(address, FILE, 1)).alias("arquivo"),
        F.col("_metadata.file_block_start").alias("_bloco"),
        F.monotonically_increasing_id().alias("_linha"),
        *cols,
    )


def raw_lines(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", header: bool = False
) -> DataFrame:
    """Every line of the files with its place; with ``header`` all but the first of a file."""
    paths = paths if isinstance(paths, str) else list(paths)
    frame = spark.read.csv(
        paths, schema="line string", sep="\u0001", encoding=encoding, quote="", header=header
    )
    return _placed(frame, F.col("line"))


def _titles(line: str, sep: str, quoted: bool) -> list[str]:
    """Titles of a header; trailing separators leave empty ones that name no column."""
    cells = next(csv.reader([line], delimiter=sep), []) if quoted else line.split(sep)
    while cells and not cells[-1].strip():
        cells.pop()
    return cells


def column_names(titles: Sequence[str]) -> list[str]:
    """Normalised titles, a repeated one numbered."""
    seen: dict[str, int] = {}
    out = []
    for title in titles:
        name = normalize_name(title)
        before = seen.get(name, 0)
        seen[name] = before + 1
        out.append(f"{name}_{before}" if name and before else name)
    return out


def _first_records(lines: DataFrame) -> DataFrame:
    """The first record of each file, whose quoted cells may hold line breaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, record, found = None, None, []
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("caminho", "line"))
            for place, line in zip(*columns):
                if place != path:
                    path, record = place, ""
                elif record is None:
                    continue
                record = line if record == "" else f"{record}\n{line}"
                if record.count('"') % 2 == 0:
                    found.append((path, record))
                    record = None
        if found:
            yield pa.RecordBatch.from_pylist([{"caminho": p, "line": r} for p, r in found])

    first = lines.where(F.col("_bloco") == 0).select("caminho", F.coalesce("line", F.lit("")).alias("line"))
    return first.mapInArrow(run, "caminho string, line string")


def header_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    first_cells: Iterable[str] | None = None,
    quoted: bool = False,
) -> dict[str, str]:
    """The header row of each file, by its address.

    It is the first line whose first cell is one of ``first_cells`` once normalised, or simply
    the first record. Fails, naming every file that is not empty and has none. The driver has
    listed the files already; it gets one line of each.
    """
    lines = raw_lines(spark, paths, encoding)
    if first_cells is not None:
        cell = F.split("line", f"[{sep}]")[0]
        wanted = lines.where(_plain(cell).isin(list(first_cells)))
        tops = wanted.groupBy("caminho").agg(
            F.min_by("line", F.struct("_bloco", "_linha")).alias("line")
        )
    elif quoted:
        tops = _first_records(lines)
    else:
        tops = lines.where(F.col("_bloco") == 0).groupBy("caminho").agg(
            F.min_by("line", "_linha").alias("line")
        )
    found = {r["caminho"]: r["line"] for r in tops.collect()}
    known = {_place(address) for address in found}
    lost = [f for f in lines.inputFiles() if _place(f) not in known and length(spark, f)]
    if lost:
        raise ValueError("No header row in: " + ", ".join(sorted(lost)))
    return found


def _place(address: str) -> str:
    return unquote(urlparse(address).path)


def _readable(address: str) -> str:
    """A file's address as a path to read: without escapes, and with signs that have a meaning
    in patterns taken literally."""
    parts = urlparse(address)
    place = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(parts.path))
    return f"{parts.scheme}://{parts.netloc}{place}" if parts.scheme else place


def headers(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    first_cells: Iterable[str] | None = None,
) -> DataFrame:
    """One row per file: raw ``titulos`` and normalised ``colunas``."""
    rows = []
    for address, line in header_lines(spark, paths, sep, encoding, first_cells).items():
        titles = _titles(line, sep, False)
        rows.append((address, titles, column_names(titles)))
    return spark.createDataFrame(rows, "caminho string, titulos array<string>, colunas array<string>")


def _below(lines: DataFrame, header: str) -> DataFrame:
    """The lines below the header line of their file. A file's lines come in order; its header
    lies in the first block that Spark cuts it into, as preambles are short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, below = None, True
        for batch in batches:
            paths, blocks = batch.column("caminho"), batch.column("_bloco")
            starts = [0]
            if len(batch) > 1:
                changes = pc.not_equal(paths.slice(1), paths.slice(0, len(batch) - 1))
                starts += [i + 1 for i in pc.indices_nonzero(changes).to_pylist()]
            for start, end in zip(starts, [*starts[1:], len(batch)]):
                if paths[start].as_py() != path:
                    if not below:
                        raise ValueError(f"The header lies beyond the first block of {path}.")
                    path, below = paths[start].as_py(), blocks[start].as_py() > 0
                part = batch.slice(start, end - start)
                if not below:
                    at = pc.index(part.column("line"), header).as_py()
                    if at < 0:
                        continue
                    below, part = True, part.slice(at + 1)
                if len(part):
                    yield part

        if not below:
            raise ValueError(f"The header lies beyond the first block of {path}.")

    return lines.mapInArrow(run, lines.schema)


def read_headed(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    first_cells: Iterable[str] | None = None,
    quoted: bool = False,
) -> DataFrame:
    """Union of files with differing headers, as text columns.

    Also has ``arquivo``, ``colunas`` (what the row's file has) and the place of the row. One
    pass finds the headers; then the files of each header are read with their own positions,
    and as wide as it is. Plain lines are read whole and split, also below a preamble; quoted
    cells, which may hold separators and line breaks, are left to the CSV parser and have
    their header first.
    """
    if quoted and first_cells is not None:
        raise ValueError("Files with quoted cells have their header in the first row.")
    alike: dict[tuple[str, ...], dict[str, list[str]]] = {}
    for address, line in header_lines(spark, paths, sep, encoding, first_cells, quoted).items():
        group = alike.setdefault(tuple(_titles(line, sep, quoted)), {})
        group.setdefault(line, []).append(_readable(address))
    layouts = {titles: column_names(titles) for titles in alike}
    first_at: dict[str, int] = {}
    for names in layouts.values():
        for at, name in enumerate(names):
            if name:
                first_at[name] = min(at, first_at.get(name, at))
    columns = sorted(first_at, key=lambda n: (first_at[n], n))
    if not columns:
        raise ValueError("No titles in any header row.")
    frames = []
    for titles, group in alike.items():
        names = layouts[titles]
        if quoted:
            files = [f for of in group.values() for f in of]
            schema = ", ".join(f"c{i} string" for i in range(len(names)))
            read = spark.read.csv(
                files, schema=schema, sep=sep, encoding=encoding, multiLine=True, escape='"',
                header=True, enforceSchema=True,
            )
            rows = [_placed(read, F.array(*read.columns).alias("_cells"))]
        else:
            rows = []
            for line, files in group.items():
                lines = raw_lines(spark, files, encoding, header=first_cells is None)
                if first_cells is not None:
                    lines = _below(lines, line)
                rows.append(lines.select(*PLACE, F.split("line", f"[{sep}]").alias("_cells")))
        listed = F.array(*[F.lit(n) for n in names]).alias("colunas")
        cells = [
            F.get("_cells", F.lit(names.index(c))).alias(c) if c in names else F.lit(None).cast("string").alias(c)
            for c in columns
        ]
        frames += [part.select(*PLACE, listed, *cells) for part in rows]
    return union_all(frames)


def file_catalogue(table: DataFrame) -> DataFrame:
    """Per file: year in its name or folder, path, row count, column count."""
    in_name = F.regexp_extract_all("arquivo", F.lit(r"((?:19|20)\d\d)"), F.lit(1))
    in_folder = F.regexp_extract_all("caminho", F.lit(r"/((?:19|20)\d\d)(?=/)"), F.lit(1))
    year = F.coalesce(F.try_element_at(in_name, F.lit(-1)), F.try_element_at(in_folder, F.lit(-1)))
    named = F.array_compact(F.array_remove("colunas", ""))
    return (
        table.groupBy("caminho", "arquivo")
        .agg(F.count("*").alias("qtd_linhas"), F.max(F.size(named)).alias("qtd_colunas"))
        .select(
            year.cast("int").alias("ano"),
            "arquivo",
            "caminho",
            "qtd_linhas",
            "qtd_colunas",
        )
    )
