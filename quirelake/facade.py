"""One object for the common uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.operators import chunking, chunks, graph, sparql, vectors
from quirelake.sinks import export
from quirelake.sources import files


class Engine:
    """Documents to segments, chunks and a graph, and queries on them."""

    def __init__(self, spark: SparkSession, triples: DataFrame | None = None, embeddings: DataFrame | None = None):
        self.spark, self.triples, self.embeddings = spark, triples, embeddings

    def parse(self, folder: str, pattern: str = "*") -> DataFrame:
        """Segments of all documents below a folder."""
        return files.parse(files.scan(self.spark, folder, pattern))

    def chunk_documents(self, documents: DataFrame, segments: DataFrame, visuals: DataFrame, max_tokens: int = 2000, min_tokens: int = 200) -> DataFrame:
        """Chunks of whole documents with visuals, groups by document type and inherited context."""
        return chunking.chunk_documents(documents, segments, visuals, max_tokens, min_tokens)

    def chunk(self, segments: DataFrame, max_tokens: int = 2000, min_tokens: int = 200) -> DataFrame:
        """Chunks of segments, with their validity."""
        return chunks.assemble(chunks.pack_segments(segments, max_tokens), max_tokens=max_tokens, min_tokens=min_tokens)

    def sparql(self, query: str) -> DataFrame:
        return sparql.run(self.triples, query)

    def search(self, vector: list[float], k: int = 10, least: float = 0.7) -> DataFrame:
        return vectors.top_similar(self.embeddings, vector, k, least)

    def explore(self, node: str, depth: int = 2) -> DataFrame:
        return graph.explore(self.triples, node, depth)

    def statistics(self) -> DataFrame:
        return graph.statistics(self.triples)

    def entities(self, text: str, kind: str | None = None, limit: int = 50) -> DataFrame:
        return graph.entity_search(self.triples, text, kind, limit)

    def add(self, triples: DataFrame) -> Engine:
        """An engine whose graph has these triples too, each once."""
        both = triples if self.triples is None else self.triples.unionByName(triples, allowMissingColumns=True)
        return Engine(self.spark, both.dropDuplicates(["subject", "predicate", "object"]), self.embeddings)

    def add_vectors(self, vectors_: DataFrame, id_col: str = "vec_id") -> Engine:
        """An engine that searches these vectors too; of one id the added vector counts."""
        old = None if self.embeddings is None else self.embeddings.join(vectors_.select(id_col), id_col, "left_anti")
        return Engine(self.spark, self.triples, vectors_ if old is None else old.unionByName(vectors_, allowMissingColumns=True))

    def export(self, path: str, kind: str = "ntriples") -> None:
        export.write_graph(self.triples.select("subject", "predicate", F.col("object")), path, kind)
