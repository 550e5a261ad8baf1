"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that an operator might use itself
    T.StructField("ids", T.StringType()), T.StructField("rid", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("shard", T.LongType())])


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def rows(seed=3):
    rng = random.Random(seed)
    base = words(rng, 80)
    near = base.split()
    near[40] = "changed"
    long_text = words(rng, 12_000, 5000)
    texts = [None, "", " \n\t ", "one", "one two three", base, base, " ".join(near), base.upper(),
             long_text, "a" * 3000, "don't ''s 's've 1²3 été 中文 x \u0085 y\x1c z  \n\n q",
             "line one here\nline two here\n\nline one here\nline two here", "..?! ## $$",
             words(rng, 30) + " " + base[:250] + " " + words(rng, 30), "x\x00y", "été" * 50]
    out = [(i * 100 if i % 3 else i, t, "en" if i % 4 else None, f"s{i % 2}", len(t or ""), "c", 1, 2, 3)
           for i, t in enumerate(texts)]
    out.append(out[5])                                            # a repeated row
    out.append((out[7][0], "another text under a used id", None, None, None, None, None, None, None))
    out.append((None, base, None, None, None, None, None, None, None))
    out.append((None, None, None, None, None, None, None, None, None))
    return out


def table(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame(data, SCHEMA)


def write(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
