"""Two-dimensional projection for charts."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pca_projection(df: DataFrame, cols: list[str], k: int = 2, keep=("customerID", "cluster_id")) -> tuple[DataFrame, list[float]]:
    """(kept columns, pc_1 ... pc_k) and the explained variance ratios.

    Columns are centred first (Spark's model does not); the sign makes each
    component's largest loading positive. Rows with a null feature are an
    error."""
    from segmint.operators.kmeans import check_features
    check_features(df, cols)
    q = [F.col("`" + c.replace("`", "``") + "`").cast("double") for c in cols]
    mean = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(q)]).first()  # one row of d numbers
    kept = [c for c in keep if c in df.columns]
    x = df.select(*kept, array_to_vector(F.array(*[c - F.lit(float(mean[i])) for i, c in enumerate(q)])).alias("_x"))
    model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(x)
    load = model.pc.toArray()  # d x k
    sign = [1.0 if load[abs(load[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    pc = vector_to_array("_pc")
    out = model.transform(x).select(*kept, *[(pc[j] * F.lit(sign[j])).alias(f"pc_{j + 1}") for j in range(k)])
    return out, [float(v) for v in model.explainedVariance]
