"""Writing results: contract files, long tables, threshold searches, a zip of both."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lists(collected: DataFrame, path: str, header: tuple[str, str], one_file: bool = False, compression: str = "none") -> None:
    """Lines of id, tab and comma-joined ids, blank where there are none, after a header line.

    Text, not CSV, so nothing is quoted or escaped. Rows are ordered by id over all files and the header comes first;
    one_file: as one file, for a reader that wants that. compression: of Spark's text files, for lists that only Spark reads.
    """
    lines = collected.select(F.lit(1).alias("_at"), "source1_entity_id", F.concat_ws("\t", "source1_entity_id", F.array_join("ids", ",")).alias("value"))
    head = collected.sparkSession.createDataFrame([(0, "", "\t".join(header))], "_at int, source1_entity_id string, value string")
    lines = head.unionByName(lines).orderBy("_at", "source1_entity_id").select("value")
    (lines.coalesce(1) if one_file else lines).write.mode("overwrite").option("compression", compression).text(path)


def write_pairs(pairs: DataFrame, path: str, by_country: bool = False) -> None:
    """A long table of pairs; by_country: a folder for each country, so that later reads skip the others."""
    writer = pairs.write.mode("overwrite")
    (writer.partitionBy("country") if by_country else writer).parquet(path)


def write_tsv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")


def write_search(search: DataFrame, path: str) -> None:
    write_tsv(search.select("threshold", F.round("macro_f05", 4).alias("macro_f05")).orderBy("threshold").coalesce(1), path)


def zip_results(folders: dict[str, str], target: str) -> None:
    """A zip with each local output folder's part files as one member of that name; fails if one has none. Caches and dotfiles stay out."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for name, folder in folders.items():
            parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
            if not parts:
                raise FileNotFoundError(f"{folder} holds no output")
            with out.open(name, "w") as to:
                for p in parts:
                    with open(os.path.join(folder, p), "rb") as of:
                        while block := of.read(1 << 20):
                            to.write(block)


def package(target: str, results: dict[str, str], extra: list[str]) -> None:
    """zip_results and local files or folders of code and documents."""
    zip_results(results, target)
    with zipfile.ZipFile(target, "a", zipfile.ZIP_DEFLATED) as out:
        for top in extra:
            base = os.path.dirname(os.path.abspath(top))
            found = [top] if os.path.isfile(top) else [os.path.join(d, f) for d, _, names in os.walk(top) for f in names]
            for path in sorted(found):
                name = os.path.relpath(os.path.abspath(path), base)
                if not any(part.startswith(".") or part == "__pycache__" for part in name.split(os.sep)):
                    out.write(path, name)
