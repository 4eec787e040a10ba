from datetime import datetime, timedelta

T0 = datetime(2026, 1, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def arrival(spark, rows, columns, per_chunk=3, deployment="d"):
    """DataFrame in list order with small chunks, so that state has to cross chunk edges."""
    data = [(deployment, *r, i // per_chunk, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, f"deployment_id STRING, {columns}, chunk BIGINT, pos BIGINT")


def valve(spark, rows, per_chunk=3, deployment="d"):
    return arrival(spark, [(at(t), c, f) for t, c, f in rows], "ts TIMESTAMP_NTZ, chamber STRING, flush_state STRING", per_chunk, deployment)


def rga(spark, rows, per_chunk=3, deployment="d"):
    return arrival(spark, [(at(t), m, float(c)) for t, m, c in rows], "ts TIMESTAMP_NTZ, mass BIGINT, current DOUBLE", per_chunk, deployment)


def values(df, *columns, order=None):
    rows = df.orderBy(*(order or columns)).select(*columns).collect()
    return [tuple(r) if len(columns) > 1 else r[0] for r in rows]
