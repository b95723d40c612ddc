"""The export reader on files split over many scan partitions."""

import random

from pyspark.sql import functions as F

from tests.exportfiles import headers, write_export
from trackyard.plans import bronze
from trackyard.sources import exports as X


def _etcs_rows(n, offset=0):
    rows = []
    for i in range(n):
        r = [""] * 26
        r[0] = f"2026-05-13 {(i // 3600) % 24:02d}:{(i // 60) % 60:02d}:{i % 60:02d}.{offset:03d}"
        r[2] = f"{i % 9}s {i % 1000}ms"
        r[8] = str(604070051700000 + i)
        rows.append(r)
    return rows


def test_line_numbers_across_splits(spark, tmp_path):
    folder = str(tmp_path / "in")
    big = write_export(folder, "ETCS-Call-tracing_big.csv", headers("exp_etcs_call"), _etcs_rows(5000))
    small = write_export(folder, "ETCS-Call-tracing_small.csv", headers("exp_etcs_call"), _etcs_rows(7, 1),
                         sep_line=False)
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        paths = ["file:" + big, "file:" + small]
        assert spark.read.text(paths).rdd.getNumPartitions() > 20
        lines = X.numbered_records(spark, paths)
        got = {(r["path"].split("/")[-1], r["line_index"]): r["value"] for r in lines.collect()}
        for name, path in (("ETCS-Call-tracing_big.csv", big), ("ETCS-Call-tracing_small.csv", small)):
            with open(path, encoding="utf-8-sig") as f:
                expected = [ln.rstrip("\r\n") for ln in f if ln.strip()]
            assert [got[(name, i)] for i in range(len(expected))] == expected
            assert (name, len(expected)) not in got
        listing = X.list_files(spark, folder)
        files = X.content_files(X.survey(spark, paths), listing).collect()
        heads = {r["filename"]: r["header_index"] for r in files}
        assert all(r["header"].lower() == ";".join(headers("exp_etcs_call")).lower() and not r["multi"] for r in files)
        assert heads == {"ETCS-Call-tracing_big.csv": 1, "ETCS-Call-tracing_small.csv": 0}

        root = str(tmp_path / "wh")
        _, status, st = bronze.run_ingestion(spark, folder, None, root)
        assert status == "SUCCESS" and st.rows_loaded == 5007
        b = bronze.read_bronze(spark, root, "exp_etcs_call")
        big_rows = b.filter(F.col("_source_file") == "ETCS-Call-tracing_big.csv")
        # _row_num is the data row's position in its file, imsi encodes the same position
        assert big_rows.filter(F.col("_row_num") != F.col("imsi") - 604070051700000 + 1).count() == 0
        assert sorted(r[0] for r in b.filter(F.col("_source_file") == "ETCS-Call-tracing_small.csv")
                      .select("_row_num").collect()) == list(range(1, 8))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)


def test_quoted_fields_and_blank_lines(spark, tmp_path):
    folder = str(tmp_path / "in")
    h = headers("exp_etcs_call")
    rows = _etcs_rows(3)
    rows[1][25] = '"probe; patch panel ""A"""'
    path = write_export(folder, "ETCS-Call-tracing_q.csv", h, rows)
    with open(path, "ab") as f:
        f.write(b"\r\n\r\n")  # trailing blank lines are not rows
    root = str(tmp_path / "wh")
    _, status, st = bronze.run_ingestion(spark, folder, None, root)
    assert status == "SUCCESS" and st.rows_loaded == 3
    b = bronze.read_bronze(spark, root, "exp_etcs_call").orderBy("_row_num").collect()
    assert b[1]["isdn_port_probe"] == 'probe; patch panel "A"'
    assert [r["_row_num"] for r in b] == [1, 2, 3]


def test_special_characters_in_names(spark, tmp_path):
    """Spaces, '#', '%', '+', accents and glob characters in folder and file names."""
    folder = str(tmp_path / "my exports+x")
    write_export(folder, "ETCS-Call-tracing #1 (é) 100%.csv", headers("exp_etcs_call"), _etcs_rows(4))
    write_export(folder, "ETCS-Call-tracing [a]+{b}.csv", headers("exp_etcs_call"), _etcs_rows(3, 2))
    root = str(tmp_path / "wh")
    _, status, st = bronze.run_ingestion(spark, folder, None, root)
    assert status == "SUCCESS" and st.rows_loaded == 7
    got = {r["_source_file"]: r["n"] for r in
           bronze.read_bronze(spark, root, "exp_etcs_call").groupBy("_source_file").agg(F.count("*").alias("n")).collect()}
    assert got == {"ETCS-Call-tracing #1 (é) 100%.csv": 4, "ETCS-Call-tracing [a]+{b}.csv": 3}


CELLS = ['"a;b"', '"say ""x"""', '"two\nlines"', '"blank\n\n  \ninside; ""q""\n"', 'plain', '', '5" pipe', '""', '"xy"', '"end""\n"']


def test_line_breaks_in_cells_across_splits(spark, tmp_path):
    """Records, their numbers and fields are those of a CSV reader, whatever the splits; no cell's quote is taken for another's."""
    import csv

    folder = tmp_path / "in"
    folder.mkdir()
    expected = {}
    for name, n, eol in (("a.csv", 400, "\n"), ("b.csv", 7, "\r\n"), ("c.csv", 60, "\n")):
        rows = [[str(i), CELLS[(i * 7 + len(name)) % len(CELLS)], CELLS[(i * i) % len(CELLS)], "e"] for i in range(n)]
        if name == "c.csv":
            rows = [[c.replace("\n", " ") for c in r] for r in rows]
        text = eol.join(";".join(r) for r in rows) + eol
        (folder / name).write_bytes(text.encode())
        read = [r for r in csv.reader(text.replace("\r\n", "\n").splitlines(keepends=True), delimiter=";") if r]
        expected[name] = [[c or None for c in r] for r in read]
        assert len(read) == n
    paths = [f"file:{folder}/{n}" for n in expected]
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    ids = []
    try:
        for size in ("50", "333", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = X.numbered_records(spark, paths).withColumn("cell", X.cells(F.col("value"), 4)).withColumn(
                "n", X.token_count(F.col("value"))).collect()
            for name, rows in expected.items():
                mine = sorted((r["line_index"], r["cell"], r["n"]) for r in found if r["path"].endswith(name))
                assert [m[0] for m in mine] == list(range(len(rows)))
                assert [m[1] for m in mine] == rows and all(m[2] == 4 for m in mine)
            listing = X.list_files(spark, str(folder))
            ids.append(sorted((r["filename"], r["file_id"], r["multi"]) for r in
                              X.content_files(X.survey(spark, paths), listing).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert ids[0] == ids[1] == ids[2] and [m for _, _, m in ids[0]] == [True, True, False]


def test_content_ids_tell_contents_apart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f"{i};x{i % 3}" for i in range(50)]
    other = [*lines[:10], lines[11], lines[10], *lines[12:]]
    contents = {"a": "\n".join(lines), "copy": "\n".join(lines), "end": "\n".join(lines) + "\n", "order": "\n".join(other),
                "crlf": "\r\n".join(lines), "mark": "\ufeff" + "\n".join(lines), "empty": "", "blank": "\n", "turn": "\n".join(lines[::-1])}
    for name, text in contents.items():
        (folder / name).write_bytes(text.encode())
    listing = X.list_files(spark, str(folder))
    splits = X.survey(spark, [r["path"] for r in listing.collect()])
    ids = {r["filename"]: r["file_id"] for r in X.content_files(splits, listing).collect()}
    assert ids["a"] == ids["copy"] and len(set(ids.values())) == len(contents) - 1


def test_layouts_are_rows(spark, tmp_path):
    """Forty header lines of one table in one load, and an unclosed cell beside them."""
    folder, h = str(tmp_path / "in"), headers("exp_ho_tracing")
    row = ["2026-05-13 10:00:00.000", "", "2026-05-13 10:00:30.000", "1.5", "1", "2", "3", "4", "604070051706194", "", "", "",
           "Voice", "", '"a; ""b""', "", ""]
    row[14] = '"a; ""b""\n\nc"'
    for k in range(40):
        by = k % 17
        short = [x for i, x in enumerate(zip(h, row, strict=True)) if k < 17 or i != 5 + k % 3]
        turned = short[by % len(short):] + short[:by % len(short)]
        turned[0] = (f"  {turned[0][0].upper()}\t", turned[0][1])
        write_export(folder, f"HO-tracing_{k:02d}.csv", [a for a, _ in turned], [[b for _, b in turned]] * 2)
    write_export(folder, "HO-tracing_x.csv", h, [row, ['"never', *row[1:]]])
    root = str(tmp_path / "wh")
    _, status, st = bronze.run_ingestion(spark, folder, None, root)
    assert status == "PARTIAL" and (st.files_success, st.files_failed, st.rows_loaded) == (40, 1, 80)
    b = bronze.read_bronze(spark, root, "exp_ho_tracing")
    assert b.filter("imsi = 604070051706194 and ho_duration = 1.5 and call_type = 'Voice'").count() == 80
    assert {r[0] for r in b.select("ho_end_event").distinct().collect()} == {'a; "b"\n\nc'}
    assert sum(b.filter(f"{c} is null").count() for c in ("src_ci", "trg_lac", "trg_ci")) == 2 * 23


def test_lines_are_read_once_and_their_quotes_followed(spark, tmp_path):
    def end(text, state, fields=1):  # 0 at a cell's start, 1 in plain text, 2 in a quoted cell, 3 after its quote
        for ch in text:
            if ch == '"':
                state = {0: 2, 1: 1, 2: 3, 3: 2}[state]
            elif state != 2:
                fields, state = fields + (ch == ";"), 0 if ch == ";" else 1
        return state, fields

    r = random.Random(3)
    texts = ["".join(r.choice('"";ab') for _ in range(r.randrange(12))) for _ in range(3000)]
    v = F.col("value")
    found = spark.createDataFrame([(t,) for t in texts], "value string").select(
        v, X.leaves_open(v, False).alias("c"), X.leaves_open(v, True).alias("o"), X.token_count(v).alias("n")).collect()
    for row in found:
        closed, opened = end(row.value, 0), end(row.value, 2)
        assert (row.c, row.o, row.n) == (closed[0] == 2, opened[0] == 2, closed[1]), row.value
    (tmp_path / "f").write_text('h;i\n1;"a\nb"\n2;c\n')
    records, _ = X.multi_line_records(spark, [str(tmp_path / "f")])
    assert "FileScan text" not in records._jdf.queryExecution().toString()  # their states are written once
    assert sorted((x.id, x.value) for x in records.collect()) == [(0, "h;i"), (1, '1;"a\nb"'), (2, "2;c")]


def test_survey_adds_in_64_bits_and_decodes_encoded_paths_only(spark, tmp_path):
    """Digest sums stay in longs, the ends of their range included; a path is decoded where its URI holds a '%'."""
    folder = tmp_path / "in"
    folder.mkdir()
    names = ["a%2Bb+c", "plain+x", "two words", "100%", "é#1", "k=v"]
    for n in names:
        (folder / n).write_text("h;x\n1;2\n3;4\n")
    listing = X.list_files(spark, str(folder))
    splits = X.survey(spark, [r["path"] for r in listing.collect()])
    assert "decimal" not in splits._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "contains(" in splits._jdf.queryExecution().optimizedPlan().toString().lower()
    files = X.content_files(splits, listing).collect()
    assert sorted(r["filename"] for r in files) == sorted(names)
    assert {r["header"] for r in files} == {"h;x"} and len({r["file_id"] for r in files}) == 1
    # splits whose sums and places are as large as they get: two neighbours, the second one's places beyond them
    top = X._PRIME - 1
    sums = ", ".join(f"cast({top} as bigint) {x}{k}" for k in range(X.LANES) for x in "st")
    two = spark.sql(f"""SELECT 'p' AS path, b AS block, cast(1 as bigint) << 32 AS n, f AS first, 0L AS n_open,
                        array(named_struct('id', 0L, 'value', 'h')) AS heads, {sums}
                        FROM VALUES (0L, 0L), (1L, 8589934591L) AS t(b, f)""")
    rows = X.content_files(two, spark.createDataFrame([("p", 1, "p")], "path string, length bigint, filename string")).collect()
    assert len(rows[0]["file_id"]) == 64


def test_lines_are_joined_where_they_are_read(spark, tmp_path, monkeypatch):
    """Cells and headers with line breaks load alike however files are split; no copy of the lines is written for it."""
    h, rows, folder = headers("exp_etcs_call"), _etcs_rows(60), tmp_path / "in"
    folder.mkdir()
    for i, r in enumerate(rows):
        r[25] = ('"a; ""b""\n\nc"', "plain", '"one line"', '"\n"', '"' + "long\n" * 40 + '"')[i % 5]
    files = {"plain": [h, *rows[:9]], "broken": [[f'"{h[0]}\n"', *h[1:]], *rows], "open": [h, *rows[9:20], ["1", '"never']]}
    for name, lines in files.items():
        (folder / f"ETCS-Call-tracing_{name}.csv").write_text("sep=;\n\n" + "".join(";".join(r) + "\n" for r in lines))
    frozen, freeze = [], X.freeze

    def counted(df):
        out = freeze(df)
        frozen.append(out.count())
        return out

    monkeypatch.setattr(X, "freeze", counted)
    loaded, prev = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("200", "900", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            root = str(tmp_path / f"wh{size}")
            frozen.clear()
            _, status, st = bronze.run_ingestion(spark, str(folder), None, root)
            assert (status, st.files_success, st.files_failed, st.rows_loaded) == ("PARTIAL", 2, 1, 69)
            b = bronze.read_bronze(spark, root, "exp_etcs_call")
            loaded.append(sorted(b.select("_source_file", "_row_num", "imsi", "start_time", "isdn_port_probe").collect(), key=str))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert loaded[0] == loaded[1] == loaded[2] and all(r.start_time for r in loaded[0])
    texts = {r._row_num: r.isdn_port_probe for r in loaded[0] if "broken" in r._source_file}
    assert [texts[i] for i in (1, 2, 3, 5)] == ['a; "b"\n\nc', "plain", "one line", "long\n" * 40]
    assert max(frozen) <= len(files)  # of files in one split each: rows a split
