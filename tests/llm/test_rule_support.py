"""What it takes for a URL rule to be mined."""

from pyspark.sql import functions as F

from tidemark.llm import url_rules


def verdicts(spark, bad, good):
    urls = [(i, u, 0) for i, u in enumerate(bad)]
    urls += [(len(bad) + i, u, 1) for i, u in enumerate(good)]
    df = spark.createDataFrame(urls, "page_id long, url string, quality int")
    labels = df.select(F.col("page_id").alias("doc_id"), "quality", F.lit(0).alias("toxic"))
    found = url_rules.filter_urls(df, labels).collect()
    return {r.page_id: r.verdict for r in found}


def test_support_does_not_rise_with_the_table(spark):
    bad = [f"https://spam.org/p{i}/x" for i in range(25)]
    good = [f"https://fine{i % 40}.org/a{i % 9}/x" for i in range(30_000)]
    got = verdicts(spark, bad, good)
    assert all(got[i] == ("block" if i < 25 else "allow") for i in got)


def test_names_in_front_of_a_host_do_not_split_it(spark):
    fronts = ["www.", "m.", "blog.", ""]
    bad = [f"https://{fronts[i % 4]}spam.co.uk/a{i}/x" for i in range(32)]
    good = [f"https://{fronts[i % 4]}fine{i}.co.uk/b{i}/x" for i in range(200)]
    got = verdicts(spark, bad, good)
    assert all(got[i] == ("block" if i < 32 else "allow") for i in got)


def test_query_equals_sql_where_rules_are_mined(spark, tmp_path):
    """A table on which mined rules decide pages, against the SQL of the query."""
    import duckdb

    from tidemark.llm import queries

    pages = [(i, f"https://www{i % 3 or ''}.spam.co.uk/shop/{i}.html?id={i}#a") for i in range(40)]
    pages += [(100 + i, f"http://blog.m.news{i % 9}.org/a/b{i}") for i in range(150)]
    pages += [(300 + i, f"https://m.pills.io/buy/now?ref={i}&x=1") for i in range(30)]
    pages += [(400, "http://www.example.com/en/x"), (401, "http://a.net/fr/"), (402, None), (403, "no")]
    pages += [(500 + i, f"HTTP://Sub.WWW.spam.co.uk/shop/z{i}") for i in range(9)]  # no label
    labels = [(i, 0, 0) for i in range(36)] + [(36 + i, 1, 0) for i in range(4)]
    labels += [(100 + i, 1, int(i % 30 == 0)) for i in range(150)]
    labels += [(300 + i, None, 1) for i in range(26)] + [(300, 1, 0), (None, 0, 1)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    duck = duckdb.connect()
    for table in ("pages", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    cursor = duck.execute(queries.oracle_sql()["op4_url_rules"])
    names = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall(), key=str)
    got = queries.op4_url_rules(spark, str(tmp_path))
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == want
    verdicts = {r.page_id: r.verdict for r in got.collect()}
    assert verdicts[36] == verdicts[329] == "block"  # by mined rules
    assert {verdicts[i] for i in range(100, 250)} == {"allow"}
