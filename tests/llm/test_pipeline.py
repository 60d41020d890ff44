import re


def test_stages(spark, tmp_path):
    import corpus_pipeline

    rows = []
    for i in range(60):
        rows.append((i, " ".join(f"word{(i * 31 + j * 7) % 997}x" for j in range(60)), "en" if i % 2 else "de", f"s{i % 3}", 5))
    rows += [(100, rows[0][1], "en", "s0", 5), (101, rows[1][1] + " more", "de", "s1", 5), (102, "12345 ... ###", "en", "s1", 5), (103, None, "en", "s2", 5), (104, rows[2][1].upper(), "en", "s2", 5)]
    item = " ".join(f"secret{j}" for j in range(30))
    rows.append((105, rows[3][1][:50] + " " + item, "en", "s0", 5))
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = f"{folder}/{len(kept)}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if len(kept) < 5:
            assert docs.columns == before.columns
            assert not docs.select(*docs.columns).exceptAll(before).take(1)
        assert re.match(r"[\w/ -]+$", name)
    everything = {r[0] for r in rows}
    assert kept[0] == everything - {102, 103}
    assert kept[1] == kept[0] - {100, 101, 104}
    assert kept[2] == kept[1] - {105}
    assert kept[3] == kept[2] == kept[4]
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


def write(spark, folder, rows, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, cosine double, n_tokens long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_no_documents(spark, tmp_path):
    import corpus_pipeline

    docs = write(spark, str(tmp_path), [], [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).collect() == []
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_nulls_repeats_and_clashing_columns(spark, tmp_path):
    import corpus_pipeline

    more = (0.5, 7, 0.5, 9)
    text = lambda i: " ".join(f"word{(i * 31 + j * 7) % 997}x" for j in range(40))
    rows = [(i, text(i), "en" if i % 2 else "de", f"s{i % 2}", 5, *more) for i in range(20)]
    rows += [rows[3], (None, text(50), "en", None, None, *more), (60, text(60), None, None, 5, *more), (61, "", "en", "s0", 5, *more), (62, None, "de", "s0", 5, *more), (63, text(63) + " a" * 200_000, "de", "s1", 5, *more)]
    folder = str(tmp_path)
    docs = write(spark, folder, rows, [(0, text(5)), (1, None), (2, "")])
    plain = lambda df: sorted(map(tuple, df.collect()), key=str)
    wanted = {
        "language ID": [r for r in rows if r[1]],
        "n-gram Jaccard join": rows,
        "benchmark decontamination": [r for r in rows if r[0] != 5],
        "mixing sources to target weights": rows,
    }
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert plain(out) == sorted(wanted[name], key=str)
    assert corpus_pipeline.STAGES[4][1](spark, docs, folder).count() == len(rows)


def test_file_names_sort_by_number(spark):
    import corpus_pipeline

    names = ["part-00002-x", "part-99999-x", "part-100000-x"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string")
    assert [r[0] for r in df.orderBy(corpus_pipeline._by_number(df["name"])).collect()] == names
