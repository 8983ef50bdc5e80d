"""Near-duplicate vectors by Euclidean p-stable hashing, checked by exact cosine.

Vectors are normalised, so a cosine is a Euclidean distance: 0.93 is 0.374, unlike ones are about
1.41 apart. A hash is a random projection, shifted and cut into steps of ``step``; ``hashes`` of them
make the key of one of ``tables`` tables. With the defaults a pair at 0.93 shares the key of a table
with a chance of 0.14 and of any table with 0.986, closer pairs with more; two unlike vectors of 64
dimensions share one in a table with a chance of about 2 * 10^-4. For labels of more than some 10^5
vectors raise ``hashes`` by 2 and ``tables`` by a third for each factor of 4.

Equal vectors of a label are one class, and only classes meet: ids that share a key are joined, each
pair of them is made distinct on the map side first, and the distinct pairs are joined with the
vectors once. No key has a cap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.workspace import Workspace


def _hashed(rows: DataFrame, hashes: int, tables: int, step: float, seed: int) -> DataFrame:
    """(row, vec_id, label, unit, digest, keys): normalised vectors and their keys.

    Vectors that are null, empty, zero, or hold null or non-finite components get null in all three.
    """

    def hash_all(batches):
        drawn: dict[int, tuple] = {}
        for batch in batches:
            units, keys = [], []
            for vector, label in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist()):
                unit = key = None
                if vector and label is not None and None not in vector:
                    x = np.asarray(vector, np.float64)
                    # Dividing by the largest first keeps the square from overflowing.
                    top = np.abs(x).max()
                    if np.isfinite(x).all() and top > 0:
                        x = x / top
                        x = x / np.sqrt((x * x).sum())
                        if len(x) not in drawn:
                            rng = np.random.default_rng([seed, len(x)])
                            drawn[len(x)] = (
                                rng.standard_normal((len(x), hashes * tables)),
                                rng.uniform(0, step, hashes * tables),
                                rng.integers(1, 2**62, (tables, hashes)) * 2 + 1,
                            )
                        a, b, mixers = drawn[len(x)]
                        cells = np.floor((x @ a + b) / step).astype(np.int64).reshape(tables, hashes)
                        with np.errstate(over="ignore"):
                            key = (cells * mixers).sum(axis=1).tolist()
                        unit = x.tobytes()
                units.append(unit)
                keys.append(key)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array(units, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ], ["row", "vec_id", "label", "unit", "keys"])

    return rows.mapInArrow(
        hash_all, "row bigint, vec_id bigint, label string, unit binary, keys array<bigint>"
    )


def _checked(pairs: DataFrame, cosine: float) -> DataFrame:
    """(a, b) of the rows (a, b, one, two) whose unit vectors have the cosine."""

    def check(batches):
        for batch in batches:
            one, two = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            alike = [i for i, (x, y) in enumerate(zip(one, two)) if len(x) == len(y)]
            near = [i for i in alike if np.frombuffer(one[i]) @ np.frombuffer(two[i]) >= cosine]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(near, pa.int64())) for c in (0, 1)], ["a", "b"]
            )

    return pairs.mapInArrow(check, "a bigint, b bigint")


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cosine: float = 0.93, hashes: int = 12, tables: int = 28, step: float = 2.0, seed: int = 11,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows of equal label whose vectors have a cosine of at least ``cosine`` in double precision link.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable,
    ``kept`` whether that is the row's own.

    - A null label, a null, empty or zero vector, or one with a null or non-finite component links nothing.
    - Vectors of unlike length do not link.
    - A row with a null id links nothing and gets a null component and kept false.
    - Repeated rows link with each other and are counted as rows. An empty table gives an empty table.
    """
    space = Workspace(vectors.sparkSession)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"),
    )
    hashed = space.pin(_hashed(rows, hashes, tables, step, seed).withColumn("digest", F.md5("unit")), "hashed")
    real = hashed.filter("unit IS NOT NULL AND vec_id IS NOT NULL")
    classes = space.pin(real.groupBy("label", "digest").agg(
        F.min("row").alias("node"), F.min("vec_id").alias("class_id"), F.count("*").alias("rows")
    ), "classes")
    members = real.join(classes.select("node"), F.col("row") == F.col("node")).select("node", "label", "unit", "keys")
    listed = space.pin(
        members.select("node", "label", F.posexplode("keys").alias("table", "key")).select(
            "node", F.xxhash64("label", "table", "key").alias("key")
        ), "keys",
    )
    other = listed.select(F.col("node").alias("b"), F.col("key").alias("_key"))
    met = listed.join(other, (F.col("key") == F.col("_key")) & (F.col("node") < F.col("b")))
    pairs = met.select(F.col("node").alias("a"), "b").distinct()
    units = members.select("node", "unit")
    both = pairs.join(units.select(F.col("node").alias("a"), F.col("unit").alias("one")), "a").join(
        units.select(F.col("node").alias("b"), F.col("unit").alias("two")), "b"
    )
    links = space.pin(_checked(both.select("a", "b", "one", "two"), cosine), "vector-links")
    space.drop(listed)

    roots = space.pin(components(space, links), "roots")
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("class_id").alias("component_id"))
    ends = links.union(links.select("b", "a")).select(F.col("a").alias("node"), "b")
    weights = classes.select(F.col("node").alias("b"), "rows")
    linked = ends.join(weights, "b").groupBy("node").agg(F.sum("rows").alias("linked"))
    told = rooted.join(least, "root").join(linked, "node", "left").select(
        F.col("label").alias("_label"), F.col("digest").alias("_digest"), "component_id",
        (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
    )
    counted = hashed.join(
        told, (F.col("label") == F.col("_label")) & (F.col("digest") == F.col("_digest")) & F.col("vec_id").isNotNull(), "left"
    )
    component = F.coalesce("component_id", "vec_id")
    return counted.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
