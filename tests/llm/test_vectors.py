"""Vectors of very large and very small components."""

from countloom.llm import vectors


def test_extremes(spark):
    """Cosines don't depend on the size of a vector, down to the least numbers and up to the greatest."""
    rows = [(1, "a", [1e200, 2e200]), (2, "a", [1e200, 2.01e200]), (3, "a", [1e-200, 2e-200]), (4, "a", [2e-200, 4e-200]), (5, "a", [5e-324, 1e-323]), (6, "a", [1.7e308, -1.7e308]), (7, "a", [1.0, -1.0]), (8, "b", [1.0, 2.0])]
    d = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(d).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (4, 1), 6: (1, 6), 7: (1, 6), 8: (0, 8)}
