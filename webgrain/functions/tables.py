"""Table functions for SQL: after ``register(spark)`` they stand behind ``LATERAL`` or take a ``TABLE``.

``text_chunks(text, max_length)``: (chunk, body), the greedy chunks of ``strings.partition_text``.
``page_elements(html)``: (element, tag, attributes), the elements of a page in order.
``chunks_of(TABLE(t), key, place, part, max_length)``: (key, chunk, body) of texts that come as rows of
pieces. It asks for the rows of a key in the order of ``place``, holds one chunk at a time, and so takes
texts of any length.
"""

import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import AnalyzeResult, OrderingColumn, PartitioningColumn
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from webgrain.functions.markup import attributes, scan


class TextChunks:
    """Nothing for a missing text or limit."""

    def eval(self, text: str, max_length: int):
        if text is None or max_length is None:
            return
        chunks = [m[1] for m in re.finditer(rf"(?s)(.{{0,{max_length}}}|[^ ]*) ", text + " ")]
        if len(text.split(" ", 1)[0]) >= max_length:
            chunks.insert(0, "")
        yield from enumerate(chunks)


class PageElements:
    """Nothing for a missing page; broken markup is read as far as it goes."""

    def eval(self, html: str):
        opened = (item for item in scan(html or "") if item[0] == "open")
        for n, (_, tag, source) in enumerate(opened):
            yield n, tag, attributes(source)


class ChunksOf:
    """The pieces of a key are joined by one space; missing ones are left out. A key without any gives no row."""

    def __init__(self):
        self.key, self.words, self.size, self.chunk = None, None, 0, 0

    @staticmethod
    def analyze(table, key, place, part, max_length):
        names = {f.name: f.dataType for f in table.dataType.fields}
        for column in (key, place, part):
            if column.value not in names:
                raise ValueError(f"chunks_of: no column {column.value!r} in the table")
        if not isinstance(max_length.value, int) or max_length.value < 1:
            raise ValueError("chunks_of: max_length must be a positive number")
        return AnalyzeResult(
            schema=StructType([StructField(key.value, names[key.value]), StructField("chunk", IntegerType()),
                               StructField("body", StringType())]),
            partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(place.value)])

    def _close(self):
        body, self.chunk = " ".join(self.words), self.chunk + 1
        return self.key, self.chunk - 1, body

    def eval(self, row, key, place, part, max_length):
        if row[part] is None:
            return
        self.key = row[key]
        for word in row[part].split(" "):
            if self.words is None and len(word) < max_length:
                self.words, self.size = [word], len(word)
            elif self.words is not None and self.size + len(word) < max_length:
                self.words.append(word)
                self.size += 1 + len(word)
            else:  # a long first word leaves an empty chunk in front
                self.words = self.words or []
                yield self._close()
                self.words, self.size = [word], len(word)

    def terminate(self):
        if self.words is not None:
            yield self._close()


def register(spark: SparkSession) -> None:
    """Make the table functions known to the session's SQL."""
    chunks = "chunk int, body string"
    spark.udtf.register("text_chunks", F.udtf(TextChunks, returnType=chunks, useArrow=True))
    spark.udtf.register("page_elements", F.udtf(
        PageElements, returnType="element int, tag string, attributes map<string,string>", useArrow=True))
    spark.udtf.register("chunks_of", F.udtf(ChunksOf, useArrow=True))
