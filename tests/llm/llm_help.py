DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], DOCS)


def noise(rng, n):
    return " ".join("".join(rng.choice("aeionrst") for _ in range(rng.randint(2, 7))) for _ in range(n))
