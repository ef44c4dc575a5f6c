"""Sources: by-name delimited files, archives, ledger, manifests, seeds."""

import os
import zipfile

import pytest

from terrane import domain as D
from terrane.session import local_path, scratch_dir
from terrane.sources.archive import extract_archives, extraction_log, landing_check
from terrane.sources.delimited import delimited_scan
from terrane.sources.manifest import manifest_diff, manifest_filter, manifest_summary
from terrane.sources.seed import read_seed
from terrane.streaming.ledger import load_new_files, read_loaded


def _write(path, name, text):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_by_name_binding_ragged_rows_and_quotes(spark):
    d = scratch_dir(spark, "t-delim")
    _write(d, "a.txt", "No disposition|Commune|Valeur fonciere\n"
                       '1|"Paris | 1er"|100\n2|Lyon\n3|Nice|5|extra\n4|NULL|  7  \n')
    _write(d, "b.txt", "VALEUR FONCIERE|no disposition|Autre\n9|5|x\n")
    cols = ["No disposition", "Commune", "Valeur fonciere", "Surface terrain"]
    got = sorted(tuple(r) for r in delimited_scan(spark, d, cols, glob="*.txt").collect())
    assert got == [("1", "Paris | 1er", "100", None), ("2", "Lyon", None, None), ("3", "Nice", "5", None),
                   ("4", None, "7", None), ("5", None, "9", None)]


def test_archive_scan_keeps_only_txt_members(spark):
    zips, out = scratch_dir(spark, "t-zip"), scratch_dir(spark, "t-landed")
    os.makedirs(local_path(zips), exist_ok=True)
    with zipfile.ZipFile(os.path.join(local_path(zips), "valeursfoncieres-2024.txt.zip"), "w") as z:
        z.writestr("ValeursFoncieres-2024.txt", "No disposition|Commune\n1|A\n")
        z.writestr("notice.pdf", b"%PDF")
    log = extract_archives(spark, zips, out, ".txt").collect()
    assert [r.member for r in log] == ["ValeursFoncieres-2024.txt"]
    assert [tuple(r) for r in landing_check(spark, out, ".txt").collect()] == [("ValeursFoncieres-2024.txt", 27, 2)]


def _zip(folder, name, members):
    os.makedirs(local_path(folder), exist_ok=True)
    with zipfile.ZipFile(os.path.join(local_path(folder), name), "w") as z:
        for m, text in members.items():
            z.writestr(m, text)


def test_a_damaged_archive_lands_nothing_and_a_rerun_mends_it(spark):
    zips, out = scratch_dir(spark, "t-torn"), scratch_dir(spark, "t-torn-out")
    text = "No disposition|Commune\n" + "".join(f"{i}|{i * 7919 % 10007}\n" for i in range(20000))
    _zip(zips, "a.zip", {"data.txt": text})
    file = os.path.join(local_path(zips), "a.zip")
    whole = open(file, "rb").read()
    for crc in (f for f in os.listdir(local_path(zips)) if f.endswith(".crc")):
        os.remove(os.path.join(local_path(zips), crc))
    with open(file, "wb") as f:
        f.write(whole[:200] + bytes([whole[200] ^ 255]) + whole[201:])
    with pytest.raises(Exception):
        extract_archives(spark, zips, out, ".txt")
    assert not [f for f in os.listdir(local_path(out)) if f.endswith(".txt") or f.startswith("_attempt")]
    assert extraction_log(spark, out).count() == 0
    with open(file, "wb") as f:
        f.write(whole)
    assert extract_archives(spark, zips, out, ".txt").count() == 1
    landed = os.path.join(local_path(out), "data.txt")
    assert open(landed).read() == text
    stamp = os.path.getmtime(landed)
    assert extract_archives(spark, zips, out, ".txt").count() == 1 and os.path.getmtime(landed) == stamp


def test_members_of_one_name_are_refused(spark):
    zips, out = scratch_dir(spark, "t-clash"), scratch_dir(spark, "t-clash-out")
    _zip(zips, "a.zip", {"x/data.txt": "h\n1\n"})
    _zip(zips, "b.zip", {"y/data.txt": "h\n2\n"})
    with pytest.raises(ValueError, match="data.txt"):
        extract_archives(spark, zips, out, ".txt")
    assert not os.path.isdir(local_path(out)) or not [f for f in os.listdir(local_path(out)) if f.endswith(".txt")]
    one = scratch_dir(spark, "t-clash-one")
    _zip(one, "a.zip", {"x/data.txt": "h\n1\n"})
    extract_archives(spark, one, out, ".txt")
    other = scratch_dir(spark, "t-clash-other")
    _zip(other, "c.zip", {"data.txt": "h\n3\n"})
    with pytest.raises(ValueError, match="data.txt"):
        extract_archives(spark, other, out, ".txt")


def test_header_reads_are_bounded(spark):
    d = scratch_dir(spark, "t-noline")
    _write(d, "a.txt", "x" * (3 << 20))
    with pytest.raises(Exception, match="no line end"):
        delimited_scan(spark, d, ["x"], glob="*.txt").collect()


def test_a_thousand_files_in_one_batch(spark):
    src, table, ckpt = (scratch_dir(spark, n) for n in ("t-many", "t-many-table", "t-many-ckpt"))
    cols = ["No disposition", "Commune"]
    for i in range(1000):
        _write(src, f"f{i}.txt", f"No disposition|Commune\n{i}|c{i}\n" if i % 10 else f"Commune|No disposition\nc{i}|{i}\n")
    assert load_new_files(spark, src, table, ckpt, cols) == 1000
    assert sorted(int(r[0]) for r in read_loaded(spark, table, cols).collect()) == list(range(1000))
    assert all(r[1] == f"c{r[0]}" for r in read_loaded(spark, table, cols).collect())


def test_ledger_loads_each_file_once(spark):
    src, table, ckpt = (scratch_dir(spark, n) for n in ("t-src", "t-table", "t-ckpt"))
    cols = ["No disposition", "Commune"]
    _write(src, "f1.txt", "No disposition|Commune\n1|A\n2|B\n")
    assert load_new_files(spark, src, table, ckpt, cols) == 1
    assert load_new_files(spark, src, table, ckpt, cols) == 0
    assert read_loaded(spark, table, cols).count() == 2
    _write(src, "f2.txt", "Commune|No disposition\nC|3\n")
    load_new_files(spark, src, table, ckpt, cols)
    assert sorted(tuple(r) for r in read_loaded(spark, table, cols).collect()) == [("1", "A"), ("2", "B"), ("3", "C")]


def test_manifest_cases(spark):
    catalog = spark.createDataFrame([([
        {"url": "https://x/valeursfoncieres-2024.txt.zip"}, {"url": "https://x/valeursfoncieres-2025.txt.zip"},
        {"url": "https://x/valeursfoncieres-notice.pdf"}, {"url": "https://x/other-2023.zip"}],)],
        "resources array<struct<url:string>>")
    items = manifest_filter(catalog)
    assert sorted(r.name for r in items.collect()) == ["valeursfoncieres-2024.txt.zip", "valeursfoncieres-2025.txt.zip"]
    landed = spark.createDataFrame([("ValeursFoncieres-2024.txt",)], ["name"])
    st = {r.name: r.status for r in manifest_diff(items, landed, "casefold").collect()}
    assert st == {"valeursfoncieres-2024.txt.zip": "skipped", "valeursfoncieres-2025.txt.zip": "pending"}
    st = {r.name: r.status for r in manifest_diff(items, landed, "exact").collect()}
    assert set(st.values()) == {"pending"}
    st = {r.name: r.status for r in manifest_diff(items, landed, "year").collect()}
    assert st["valeursfoncieres-2024.txt.zip"] == "skipped"
    summary = {r.status: r.files for r in manifest_summary(manifest_diff(items, landed)).collect()}
    assert summary == {"skipped": 1, "pending": 1, "total": 2}


def test_seed_keeps_codes_as_text(spark):
    d = scratch_dir(spark, "t-seed")
    _write(d, "seed.csv", "code_departement,nom_departement,region\n01,Ain,Auvergne-Rhône-Alpes\n2A,Corse-du-Sud,Corse\n")
    rows = {r.code_departement: r.region for r in read_seed(spark, d).collect()}
    assert rows == {"01": "Auvergne-Rhône-Alpes", "2A": "Corse"}
    assert len(D.BRONZE_COLUMNS) == 43


def test_run_refresh_end_to_end(spark):
    from terrane.plans.runner import run_refresh
    from terrane.plans.star import calendar
    zips, root = scratch_dir(spark, "t-refresh-zips"), scratch_dir(spark, "t-refresh")
    os.makedirs(local_path(zips), exist_ok=True)
    header = "|".join(D.BRONZE_COLUMNS)
    idx = {c: i for i, c in enumerate(D.BRONZE_COLUMNS)}

    def line(disp, doc, date, price, typ, commune):
        f = [""] * len(D.BRONZE_COLUMNS)
        vals = {"No disposition": disp, "Identifiant de document": doc, "Date mutation": date,
                "Nature mutation": "Vente", "Valeur fonciere": price, "Type local": typ, "Commune": commune,
                "Code postal": "75001", "Code departement": "75", "Surface reelle bati": "50"}
        for k, v in vals.items():
            f[idx[k]] = v
        return "|".join(f)
    with zipfile.ZipFile(os.path.join(local_path(zips), "valeursfoncieres-2021.txt.zip"), "w") as z:
        z.writestr("ValeursFoncieres-2021.txt", "\n".join([header] + [
            line("1", f"d{i}", f"2021-0{1 + i % 6}-15", f"{100000 + i},00", "Maison", "PARIS") for i in range(30)]) + "\n")
    seed = spark.createDataFrame([("75", "Paris", "Île-de-France")], ["code_departement", "nom_departement", "region"])
    cal = calendar(spark)
    first = run_refresh(spark, zips, root, seed, cal).collect()[0]
    assert first.total_count == 48 and first.fail_count == 0
    landed_file = os.path.join(local_path(root), "landed", "ValeursFoncieres-2021.txt")
    stamp = os.path.getmtime(landed_file)
    again = run_refresh(spark, zips, root, seed, cal).collect()[0]
    assert os.path.getmtime(landed_file) == stamp  # the landed archive is not extracted again
    assert again.total_count == 48
    from terrane.operators.upsert import read_partitions
    assert read_partitions(spark, root + "/silver").count() == 30


def test_year_mode_without_year_is_never_skipped(spark):
    items = spark.createDataFrame([("u1", "valeursfoncieres-notice.zip"), ("u2", "valeursfoncieres-2023.zip")],
                                  ["url", "name"])
    landed = spark.createDataFrame([("copy-of-x2023y.txt",), ("notice.txt",)], ["name"])
    st = {r.name: r.status for r in manifest_diff(items, landed, "year").collect()}
    assert st == {"valeursfoncieres-notice.zip": "pending", "valeursfoncieres-2023.zip": "skipped"}


def test_bad_lines_are_refused_by_file_line_and_reason(spark, tmp_path):
    """Mixed layouts, several blocks a file: loaded + refused = lines, and every other field is bound by name."""
    from terrane.sources.delimited import accepted, checked_lines, line_counts, rejected
    (tmp_path / "one file.txt").write_bytes(b"\xef\xbb\xbfA|b|C\n1|2|3\n\n4|caf\xe9|6\n7|\"x|y\"|9\n10|\"open|12\n13\n")
    (tmp_path / "b.txt").write_bytes(b"c|a|other\nz|y|x\n\xff|q|r\nA|b|C\n")
    long = b"".join(b"%d|%s|x\n" % (i, b"\xff" if i % 1000 == 7 else b"ok") for i in range(6000))
    (tmp_path / "long.txt").write_bytes(b"b|c|a\n" + long)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 100)
    try:
        lines = checked_lines(spark, str(tmp_path), ["a", "b", "c"], glob="*.txt")
        name = lambda f: f.rsplit("/", 1)[1].replace("%20", " ")
        bad = sorted((name(r.file), r.line, r.reason) for r in rejected(lines).collect())
        counts = {name(r.file): (r.lines, r.loaded, r.rejected) for r in line_counts(lines).collect()}
        rows = [tuple(r) for r in accepted(lines).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert bad == [("b.txt", 3, "invalid_utf8"), *[("long.txt", i + 2, "invalid_utf8") for i in range(7, 6000, 1000)],
                   ("one file.txt", 4, "invalid_utf8"), ("one file.txt", 6, "open_quote")]
    assert counts == {"b.txt": (3, 2, 1), "long.txt": (6000, 5994, 6), "one file.txt": (5, 3, 2)}
    assert {("1", "2", "3"), ("7", "x|y", "9"), ("13", None, None), ("y", None, "z"), ("b", None, "A"), ("x", "0", "ok")} <= set(rows)
    assert len(rows) == 5999


def test_a_thousand_files_of_twenty_layouts(spark, tmp_path):
    import random
    from unittest import mock

    from terrane.sources import delimited
    rnd = random.Random(5)
    columns, want = ["a", "b", "c", "d"], []
    layouts = [rnd.sample(["A", "b", "C", "d", f"extra{i}"], rnd.randrange(2, 6)) for i in range(20)]
    for i in range(1000):
        header = layouts[i % 20]
        row = {h.lower(): f"{h}{i}" for h in header}
        (tmp_path / f"f{i}.txt").write_text("|".join(header) + "\n" + "|".join(row[h.lower()] for h in header) + "\n")
        want.append(tuple(row.get(c) for c in columns))
    with mock.patch.object(delimited, "read_by_header", side_effect=AssertionError("files are read by their paths")):
        got = delimited.delimited_scan(spark, str(tmp_path), columns, glob="*.txt")
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_load_history_is_exact_after_a_rerun_and_a_failed_batch(spark, tmp_path):
    from unittest import mock

    import pytest

    from terrane.streaming import ledger
    src, table, ckpt, log = (str(tmp_path / d) for d in ("src", "table", "ckpt", "log"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "good one.txt").write_text("a|b\n1|2\n3|4\n")
    (tmp_path / "src" / "some.txt").write_bytes(b"b|a\n5|6\n\xff|7\n")
    (tmp_path / "src" / "none.txt").write_bytes(b"a\n\xff\n")
    (tmp_path / "src" / "head.txt").write_text("a|b\n")
    run = lambda: ledger.load_new_files(spark, src, table, ckpt, ["a", "b"], history_dir=log)
    with mock.patch.object(ledger, "_history", side_effect=RuntimeError("lost")), pytest.raises(Exception):
        run()
    assert run() == 4 and run() == 0
    history = lambda: {r.file.rsplit("/", 1)[1]: (r.status, r.rows_loaded, r.rows_rejected) for r in ledger.read_history(spark, log).collect()}
    want = {"good one.txt": ("loaded", 2, 0), "some.txt": ("partially_loaded", 1, 1), "none.txt": ("load_failed", 0, 1), "head.txt": ("empty", 0, 0)}
    assert history() == want
    (tmp_path / "src" / "late.txt").write_text("a\n8\n")
    assert run() == 1 and history() == want | {"late.txt": ("loaded", 1, 0)}
    assert sorted(map(tuple, ledger.read_loaded(spark, table, ["a", "b"]).collect())) == [("1", "2"), ("3", "4"), ("6", "5"), ("8", None)]


def test_ordinary_lines_are_split_and_others_parsed_alike(spark, tmp_path):
    from terrane.sources.delimited import checked_lines
    (tmp_path / "a.txt").write_text("a|b|c\n 1 |NULL|\n\"x|y\"| z|3|4\n5\n\t6\t|\"\"|null \n", encoding="utf-8")
    lines = checked_lines(spark, str(tmp_path), ["C", "a", "d"], glob="*.txt")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and plan.count("from_csv") == 1
    got = {(r.a, r.C, r.d) for r in lines.where("NOT _skip").collect()}
    assert got == {("1", None, None), ("x|y", "3", None), ("5", None, None), ("6", None, None)}


def test_the_bad_line_files_are_ordered_in_ranges(spark, tmp_path, monkeypatch):
    from terrane.plans import source_queries as S
    rows = [(str(i % 2 + 1), i, f"line {i}") for i in range(400)]
    monkeypatch.setattr(S, "bronze_of", lambda spark, sf_dir: None)
    monkeypatch.setattr(S, "_bad_lines", lambda b: spark.createDataFrame(rows, "part string, document int, text string").repartition(5))
    out = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    made = []
    join = S._join_pieces
    monkeypatch.setattr(S, "_join_pieces", lambda staged, path: made.append(len(list((p for p in __import__("pathlib").Path(staged.replace("file:", "")).rglob("*.txt.gz"))))) or join(staged, path))
    try:
        S._write_bad_lines(spark, "", out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert made[0] > 2  # several sorted pieces, one file a disposition of them
    for part in ("1", "2"):
        files = list((tmp_path / "out" / f"part={part}").glob("*.txt"))
        assert len(files) == 1
        assert files[0].read_text().splitlines() == ["|".join(S.COLS)] + [t for p, _, t in rows if p == part]
