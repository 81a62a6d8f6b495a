"""Customer tables derived from the driver's star-schema parquet tables.

``subscribers`` gives one 21-column customer record per order (see
FIXTURES.md B); ``labelled`` adds a ``cluster_id`` from three fixed centroids
so label-consuming operators can be checked without a random start.

The Spark form is written with the DataFrame API; the equivalent SQL text
(``SUBSCRIBERS_SQL`` / ``LABELLED_SQL``) is what the DuckDB oracle runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_flags(lineitem: DataFrame) -> DataFrame:
    """Per order: number of lines and six (returnflag, linestatus) flags.
    Partial aggregation happens map-side; the result is keyed by order."""
    flags = []
    for i, (rf, ls) in enumerate([("A", "F"), ("A", "O"), ("N", "F"), ("N", "O"), ("R", "F"), ("R", "O")], 1):
        hit = (F.col("l_returnflag") == rf) & (F.col("l_linestatus") == ls)
        flags.append(F.max(F.when(hit, 1).otherwise(0)).alias(f"s{i}"))
    return lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), *flags)


def _service(internet: Column, flag: str) -> Column:
    return (F.when(internet == "No", "No internet service")
            .when(F.col(flag) == 1, "Yes").otherwise("No"))


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer record per order, 21 columns (FIXTURES.md A schema)."""
    return subscribers_from_orders(spark, sf_dir, read_table(spark, sf_dir, "orders"))


def static_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(customers, line flags per order) as tables of their own, so that the
    micro-batches of a stream do not aggregate all lines again."""
    from segmint.session import materialize
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    return materialize(customer, "static-customer"), materialize(_line_flags(lines), "static-lines")


def subscribers_from_orders(spark: SparkSession, sf_dir: str, orders: DataFrame,
                            sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The same records for a given (batch or streaming) orders frame; the
    customer and line-flag sides are static, ``sides`` where given."""
    orders = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    if sides is None:
        customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        li = _line_flags(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"))
    else:
        customer, li = sides

    # orders x lineitem-flags first: both sides are keyed by order key, so the
    # aggregate's shuffle partitioning is reused by the join.
    b = orders.join(li, orders.o_orderkey == li.l_orderkey, "left").join(
        customer, orders.o_custkey == customer.c_custkey, "inner")
    months = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    tenure = F.least(F.lit(72), F.lit(2001 * 12 + 8) - months).cast("int")
    contract = (F.when(F.col("o_orderstatus") == "F", "Month-to-month")
                .when(F.col("o_orderstatus") == "O", "One year").otherwise("Two year"))
    monthly = (F.floor(F.lit(1825) + F.col("o_totalprice") / F.lit(50.0)) / F.lit(100.0)).cast("double")
    internet = (F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "Fiber optic")
                .when(F.col("c_mktsegment") == "HOUSEHOLD", "No").otherwise("DSL"))
    b = b.select(
        "o_orderkey", "c_custkey", "c_nationkey", "o_orderpriority",
        tenure.alias("tenure"), contract.alias("Contract"), monthly.alias("MonthlyCharges"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        *[F.coalesce(f"s{i}", F.lit(0)).alias(f"s{i}") for i in range(1, 7)],
        internet.alias("InternetService"),
    )
    inet = F.col("InternetService")
    yes_no = lambda cond: F.when(cond, "Yes").otherwise("No")
    churn_cut = (F.when(F.col("Contract") == "Month-to-month", 43)
                 .when(F.col("Contract") == "One year", 11).otherwise(3))
    priority = F.col("o_orderpriority")
    payment = (F.when(priority.isin("1-URGENT", "2-HIGH"), "Electronic check")
               .when(priority == "3-MEDIUM", "Mailed check")
               .when(priority == "4-NOT SPECIFIED", "Bank transfer (automatic)")
               .otherwise("Credit card (automatic)"))
    return b.select(
        F.col("o_orderkey").cast("string").alias("customerID"),
        F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(F.col("c_custkey") % 6 == 0, 1).otherwise(0).alias("SeniorCitizen"),
        yes_no(F.col("c_nationkey") % 2 == 0).alias("Partner"),
        yes_no(F.col("c_nationkey") % 10 < 3).alias("Dependents"),
        "tenure",
        F.when(F.col("c_custkey") % 10 == 0, "No").otherwise("Yes").alias("PhoneService"),
        F.when(F.col("c_custkey") % 10 == 0, "No phone service")
         .when(F.col("n_lines") > 4, "Yes").otherwise("No").alias("MultipleLines"),
        "InternetService",
        _service(inet, "s1").alias("OnlineSecurity"),
        _service(inet, "s2").alias("OnlineBackup"),
        _service(inet, "s3").alias("DeviceProtection"),
        _service(inet, "s4").alias("TechSupport"),
        _service(inet, "s5").alias("StreamingTV"),
        _service(inet, "s6").alias("StreamingMovies"),
        "Contract",
        yes_no(F.col("o_orderkey") % 5 < 3).alias("PaperlessBilling"),
        payment.alias("PaymentMethod"),
        "MonthlyCharges",
        F.when(F.col("tenure") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("MonthlyCharges") * F.col("tenure")).alias("TotalCharges"),
        yes_no(F.col("o_orderkey") % 100 < churn_cut).alias("Churn"),
    )


# Fixed centroids for the label-consuming checks: published segment means of
# tenure and MonthlyCharges, with the scale constants of FIXTURES.md B.
FIXED_CENTROIDS = [(56.01, 88.90), (30.24, 21.15), (15.17, 67.69)]
FIXED_SCALE = (24.5, 30.0)


def fixed_point_columns(tenure: str = "tenure", monthly: str = "MonthlyCharges") -> list[Column]:
    """Two scaled coordinates (x0, x1) used by the metric checks."""
    return [(F.col(tenure) / F.lit(FIXED_SCALE[0])).alias("x0"),
            (F.col(monthly) / F.lit(FIXED_SCALE[1])).alias("x1")]


def label_fixed(df: DataFrame) -> DataFrame:
    """Nearest of the three fixed centroids; ties go to the lowest id."""
    d = []
    for ct, cm in FIXED_CENTROIDS:
        a = (F.col("tenure") - F.lit(ct)) / F.lit(FIXED_SCALE[0])
        m = (F.col("MonthlyCharges") - F.lit(cm)) / F.lit(FIXED_SCALE[1])
        d.append(a * a + m * m)
    cid = (F.when((d[0] <= d[1]) & (d[0] <= d[2]), 0).when(d[1] <= d[2], 1).otherwise(2)).cast("int")
    return df.withColumn("cluster_id", cid)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_fixed(subscribers(spark, sf_dir))


SUBSCRIBERS_SQL = """
WITH li AS (
  SELECT l_orderkey, count(*) AS n_lines,
         max(CASE WHEN l_returnflag='A' AND l_linestatus='F' THEN 1 ELSE 0 END) AS s1,
         max(CASE WHEN l_returnflag='A' AND l_linestatus='O' THEN 1 ELSE 0 END) AS s2,
         max(CASE WHEN l_returnflag='N' AND l_linestatus='F' THEN 1 ELSE 0 END) AS s3,
         max(CASE WHEN l_returnflag='N' AND l_linestatus='O' THEN 1 ELSE 0 END) AS s4,
         max(CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN 1 ELSE 0 END) AS s5,
         max(CASE WHEN l_returnflag='R' AND l_linestatus='O' THEN 1 ELSE 0 END) AS s6
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT o.o_orderkey, c.c_custkey, c.c_nationkey, o.o_orderpriority,
         CAST(least(72, 2001*12+8 - (year(o.o_orderdate)*12 + month(o.o_orderdate))) AS INT) AS tenure,
         CASE o.o_orderstatus WHEN 'F' THEN 'Month-to-month' WHEN 'O' THEN 'One year' ELSE 'Two year' END AS Contract,
         CAST(floor(1825 + o.o_totalprice/50.0)/100.0 AS DOUBLE) AS MonthlyCharges,
         coalesce(li.n_lines,0) AS n_lines, coalesce(s1,0) AS s1, coalesce(s2,0) AS s2, coalesce(s3,0) AS s3,
         coalesce(s4,0) AS s4, coalesce(s5,0) AS s5, coalesce(s6,0) AS s6,
         CASE WHEN c.c_mktsegment IN ('AUTOMOBILE','MACHINERY') THEN 'Fiber optic'
              WHEN c.c_mktsegment='HOUSEHOLD' THEN 'No' ELSE 'DSL' END AS InternetService
  FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey LEFT JOIN li ON li.l_orderkey=o.o_orderkey)
SELECT CAST(o_orderkey AS VARCHAR) AS customerID,
       CASE WHEN c_custkey%2=0 THEN 'Female' ELSE 'Male' END AS gender,
       CASE WHEN c_custkey%6=0 THEN 1 ELSE 0 END AS SeniorCitizen,
       CASE WHEN c_nationkey%2=0 THEN 'Yes' ELSE 'No' END AS Partner,
       CASE WHEN c_nationkey%10<3 THEN 'Yes' ELSE 'No' END AS Dependents,
       tenure,
       CASE WHEN c_custkey%10=0 THEN 'No' ELSE 'Yes' END AS PhoneService,
       CASE WHEN c_custkey%10=0 THEN 'No phone service' WHEN n_lines>4 THEN 'Yes' ELSE 'No' END AS MultipleLines,
       InternetService,
       CASE WHEN InternetService='No' THEN 'No internet service' WHEN s1=1 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
       CASE WHEN InternetService='No' THEN 'No internet service' WHEN s2=1 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
       CASE WHEN InternetService='No' THEN 'No internet service' WHEN s3=1 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
       CASE WHEN InternetService='No' THEN 'No internet service' WHEN s4=1 THEN 'Yes' ELSE 'No' END AS TechSupport,
       CASE WHEN InternetService='No' THEN 'No internet service' WHEN s5=1 THEN 'Yes' ELSE 'No' END AS StreamingTV,
       CASE WHEN InternetService='No' THEN 'No internet service' WHEN s6=1 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
       Contract,
       CASE WHEN o_orderkey%5<3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Electronic check' WHEN '2-HIGH' THEN 'Electronic check'
            WHEN '3-MEDIUM' THEN 'Mailed check' WHEN '4-NOT SPECIFIED' THEN 'Bank transfer (automatic)'
            ELSE 'Credit card (automatic)' END AS PaymentMethod,
       MonthlyCharges,
       CASE WHEN tenure=0 THEN NULL ELSE MonthlyCharges*tenure END AS TotalCharges,
       CASE WHEN o_orderkey%100 < (CASE Contract WHEN 'Month-to-month' THEN 43 WHEN 'One year' THEN 11 ELSE 3 END)
            THEN 'Yes' ELSE 'No' END AS Churn
FROM b
"""

LABELLED_SQL = """
SELECT *, CAST(CASE WHEN d0<=d1 AND d0<=d2 THEN 0 WHEN d1<=d2 THEN 1 ELSE 2 END AS INT) AS cluster_id
FROM (SELECT *,
  ((tenure-56.01)/24.5)*((tenure-56.01)/24.5)+((MonthlyCharges-88.90)/30.0)*((MonthlyCharges-88.90)/30.0) AS d0,
  ((tenure-30.24)/24.5)*((tenure-30.24)/24.5)+((MonthlyCharges-21.15)/30.0)*((MonthlyCharges-21.15)/30.0) AS d1,
  ((tenure-15.17)/24.5)*((tenure-15.17)/24.5)+((MonthlyCharges-67.69)/30.0)*((MonthlyCharges-67.69)/30.0) AS d2
  FROM subscribers) q
"""


def with_fixture_ctes(body: str, labelled: bool = True, extra: str = "") -> str:
    """Prefix an oracle query with the fixture CTEs."""
    ctes = f"WITH subscribers AS ({SUBSCRIBERS_SQL})"
    if labelled:
        ctes += f",\nlabelled AS (SELECT * EXCLUDE (d0, d1, d2) FROM ({LABELLED_SQL}) lq)"
    if extra:
        ctes += ",\n" + extra
    return ctes + "\n" + body
