"""The index store: keyed tables as folders of Parquet that Spark writes and lists.

A folder is `<table>/[letter=<l>/]gen=<n>/write=<name>`. An insert adds a folder `write=` to
the generation that a letter has. An upsert or a rewrite puts the letters it touches, and
no others, into a new generation. Of every letter the newest generation counts, and no key
occurs twice in it, so that a read is a plain scan. Tables without letters are one part.

By contract one writer at a time changes keys that are there; inserts of different keys may
go on side by side. A read lists the table when it is made and keeps what it found: nothing
listed is written over, but by a batch that is run again under its name. Older generations
stay until they are cleaned, as no reader is known to have ended.
"""

import re
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopdex.operators.index import with_letter
from hopdex.operators.joins import is_small
from hopdex.schemas import (
    DISCOVERIES, JOB_LOGS, JOBS, PAGES, POSTINGS, WORD_ENTRIES, WORD_ENTRY_KEY,
)
from hopdex.session import stage

# table -> (schema, key, word column of tables with letter folders)
TABLES = {
    "pages": (PAGES, ["url"], None),
    "jobs": (JOBS, ["job_id"], None),
    "discoveries": (DISCOVERIES, ["job_id", "url"], None),
    "logs": (JOB_LOGS, None, None),
    "postings": (POSTINGS, ["term", "url"], "term"),
    "word_entries": (WORD_ENTRIES, WORD_ENTRY_KEY, "word"),
}


class IndexStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folders(self, table: str) -> dict[str, tuple[int, list[str]]]:
        """Per letter its newest generation and the folders of it; the letter is empty where there are none."""
        try:
            listed = self.spark.read.schema(self._stored(table)).parquet(f"{self.root}/{table}").inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        found: dict[str, tuple[int, list[str]]] = {}
        inside = re.compile(r"/((?:letter=([^/]*)/)?gen=(\d+)/write=[^/]*)/[^/]*$")
        for folder, letter, number in sorted({inside.search(unquote(f)).groups() for f in listed}, key=str):
            letter, number = letter or "", int(number)
            newest, folders = found.get(letter, (-1, []))
            if number > newest:
                found[letter] = number, [folder]
            elif number == newest:
                folders.append(folder)
        return found

    def holds(self, table: str, name: str) -> bool:
        """Whether rows of the write of this name count in the table."""
        ending = f"write={name}"
        return any(f.endswith(ending) for _, folders in self.folders(table).values() for f in folders)

    # -- reading -------------------------------------------------------------

    def _stored(self, table: str) -> T.StructType:
        schema, _, word = TABLES[table]
        parts = [T.StructField(c, T.StringType()) for c in ([*["letter"] * bool(word), "gen", "write"])]
        return T.StructType(schema.fields + parts)

    def read(self, table: str, letters: list[str] | None = None) -> DataFrame:
        """The rows of a table as it is now, or of some letters; without a shuffle.

        Postings and word entries keep their `letter` column, by which a search
        prunes folders.
        """
        parts = self.folders(table)
        where = [f"{self.root}/{table}/{f}" for part, (_, folders) in parts.items()
                 if letters is None or part in letters for f in folders]
        stored = self._stored(table)
        if not where:
            return self.spark.createDataFrame([], stored).drop("gen", "write")
        rows = self.spark.read.schema(stored).option("basePath", f"{self.root}/{table}").parquet(*where)
        return rows.drop("gen", "write")

    # -- writing -------------------------------------------------------------

    def insert(self, table: str, rows: DataFrame, name: str | None = None, scanned: bool = False) -> None:
        """Add rows with keys that the table does not hold; `scanned` as for `replace`.

        A batch that may be run again gives its name: it then replaces what the first
        run has left. `rows` must be the same each time.
        """
        self._write(table, rows, {part: number for part, (number, _) in self.folders(table).items()}, 0, name,
                    scanned)

    def upsert(self, table: str, rows: DataFrame) -> None:
        """Put rows, one of a key, in place of those with their keys; other keys are added.

        Only letters with a key that is there already are merged and written again.
        """
        _, key, word = TABLES[table]
        rows = stage(self._lettered(table, rows), table)
        parts = self.folders(table)
        asked = [r.letter for r in rows.select("letter").distinct().collect()] if word else None
        old = self.read(table, asked)
        # The stored rows meet the keys once; which of them are replaced is written down.
        keys = rows.select(*key).withColumn("_replaced", F.lit(True))
        keys = F.broadcast(keys) if is_small(keys) else keys
        marked = stage(old.join(keys, key, "left"), table)
        # No more letters than a token has characters to begin with.
        replaced = marked.filter("_replaced")
        if word:
            touched = [r.letter for r in replaced.select("letter").distinct().collect()]
            merged = F.col("letter").isin(touched)
        else:
            touched = [""] * (not replaced.isEmpty())
            merged = F.lit(bool(touched))
        kept = marked.filter(merged & F.col("_replaced").isNull()).select(*old.columns)
        last = max((number for number, _ in parts.values()), default=-1)
        moved = {part: last + 1 if part in touched else number for part, (number, _) in parts.items()}
        self._write(table, kept.unionByName(rows.select(*old.columns)), moved, 0, None, scanned=True)

    def replace(self, table: str, rows: DataFrame, scanned: bool = False) -> None:
        """Write the whole table anew. Letters that have no rows any more keep an empty generation.

        `scanned` says that `rows` are those of written tables, cheap to read twice.
        """
        parts = self.folders(table)
        last = max((number for number, _ in parts.values()), default=-1) + 1
        self._write(table, rows, {}, last, None, scanned)
        for letter, (number, _) in self.folders(table).items():
            if number < last:
                end = f"letter={letter}/" if letter else ""
                nothing = self.spark.createDataFrame([], TABLES[table][0])
                nothing.write.parquet(f"{self.root}/{table}/{end}gen={last}/write=none")

    def compact(self, table: str) -> None:
        """Write the rows of many writes as one."""
        if any(len(folders) > 1 for _, folders in self.folders(table).values()):
            self.replace(table, self.read(table), scanned=True)

    def _lettered(self, table: str, rows: DataFrame) -> DataFrame:
        schema, _, word = TABLES[table]
        rows = rows.select(*schema.names)
        return with_letter(rows, word) if word else rows

    def _write(self, table: str, rows: DataFrame, numbers: dict[str, int], other: int, name: str | None,
               scanned: bool = False) -> None:
        """Write rows as one folder `write=` of the generation `numbers` has for their letter, or `other`."""
        _, key, word = TABLES[table]
        rows = self._lettered(table, rows)
        by = ["letter", "gen", "write"] if word else ["gen", "write"]
        if word:
            gen = F.lit(other)
            if numbers:
                pairs = [F.lit(x) for pair in numbers.items() for x in pair]
                gen = F.coalesce(F.create_map(*pairs)[F.col("letter")], gen)
        else:
            gen = F.lit(numbers.get("", other))
        rows = rows.withColumns({"gen": gen, "write": F.lit(name or uuid.uuid4().hex)})
        if word:
            # Ranges over the whole key: files hold few distinct words, which lets
            # min/max statistics skip them, and a frequent word fills several files.
            # Ranging samples its input, so that is written first unless it is a scan already.
            rows = rows if scanned else stage(rows, table)
            rows = rows.repartitionByRange("letter", *key).sortWithinPartitions(*by, *key)
        # Puts each folder in place by one rename; a folder of the same name goes.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(
            f"{self.root}/{table}")
