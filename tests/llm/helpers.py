"""Small tables for the text operator tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside, as extra columns of an input
CLASHING = ["row", "doc", "key", "fp", "size", "target", "copies", "fingerprint", "component_id", "n_lines", "score", "starts", "rank", "place",
            "loser", "loser_mark", "line_keys", "line_dedup_keys", "kept_id", "kept_mark", "text_mark", "text_mark_", "decontaminate_hits", "mark", "node"]


def documents(spark, rows, clashing=True):
    """rows: (doc_id, text) or (doc_id, text, lang, source); with extra columns whose names operators use too."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df.repartition(3) if full else df


def stored(spark, df, folder):
    """A deterministic scan, as operators that number rows ask for."""
    df.write.parquet(str(folder))
    return spark.read.parquet(str(folder))
