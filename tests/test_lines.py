"""Lines that are kept, dropped and rejected."""

from playlens.functions.messages import payload
from playlens.sources import lines as readers
from playlens.streaming.replay import encode_lines
from pyspark.sql import functions as F


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_users(lines):
    parsed = readers.parse_users(lines(
        "u1→m→22→Japan→2006-08-13",
        "u2→f→→Peru→2006-02-24",
        "u3→f→30→Chile→",
        "u4→m→30→a→b→c",
        "",
        "u5→→40→Spain→2007-01-01",
        "u6→m→abc→Spain→2007-01-01",
        "u7→m→ 22 →Spain→2007-01-01",
        "u8→m→99999999999→Spain→2007-01-01",
        "u9→m→+7→Spain→2007-01-01→→",
    ))
    assert [(r.user_id, r.gender, r.age) for r in parsed.rows.orderBy("user_id").collect()] == [
        ("u1", "m", 22), ("u2", "f", None), ("u5", "", 40), ("u9", "m", 7)]
    reasons = {r.value.split("\t")[0]: r.reason for r in parsed.rejects.collect()}
    assert reasons == {
        "u3": "Error en Usuario, tamaño: 4",
        "u4": "Error en Usuario, tamaño: 6",
        "u6": "age is not a whole number",
        "u7": "age is not a whole number",
        "u8": "age is not a whole number",
    }


def test_banners(lines):
    parsed = readers.parse_banners(lines(
        "18→25→M→A", "18→25→M→A", "→→M→N", "18→→M→X", "a→25→M→B", "18→25→M", "", "18→25→m→Y→more"))
    assert sorted(parsed.rows.collect(), key=str) == sorted(
        [(18, 25, "M", "A"), (None, None, "M", "N"), (18, None, "M", "X"), (18, 25, "m", "Y")], key=str)
    assert rows(parsed.rejects.select("reason")) == [
        ("age bound is not a whole number",), ("fewer than 4 fields",)]


def test_profiles(lines):
    parsed = readers.parse_profiles(lines(
        "user_000001→m→→Japan→Aug 13, 2006", "user_000002", "user_000002→→→→", "user_000003→f→20", "",
        "u4→f→20→Peru→x→y"))
    assert rows(parsed.rows) == [("u4", "f", "20", "Peru", "x"),
                                 ("user_000001", "m", "", "Japan", "Aug 13, 2006")]
    assert rows(parsed.rejects) == [("user_000003\tf\t20", "fewer than 5 fields")]


def test_play_counts(lines):
    parsed = readers.parse_play_counts(lines(
        "ua→a1→Name One→ 2137", "ub→a1→Name 1→5→", "ub→a2→Name Two→x", "ub→a2→Name Two", ""))
    assert rows(parsed.rows) == [("ua", "a1", "Name One", 2137), ("ub", "a1", "Name 1", 5)]
    assert rows(parsed.rejects.select("reason")) == [
        ("fewer than 4 fields",), ("plays is not a whole number",)]


EVENTS = (
    "user_1→2009-05-04T23:08:57Z→a1→Name→t1→Track",
    "user_1→2009-05-04T23:09:57Z→a1→Name→→",
    "user_1→2009-05-04T23:10:57Z→a1→Name",
    "",
)


def test_event_file(lines):
    parsed = readers.parse_events(lines(*EVENTS))
    assert rows(parsed.rows.select("track_id")) == [("",), ("t1",)]
    assert parsed.rejects.count() == 2


def test_events_of_files(spark, lines, tmp_path):
    lines(*EVENTS).write.text(str(tmp_path / "events"))
    assert readers.read_events(spark, str(tmp_path / "events")).rows.count() == 2


def test_event_wire_form(lines):
    wire = encode_lines(lines(*EVENTS))
    texts = wire.select(payload(F.col("key")), payload(F.col("value")))
    assert rows(texts) == sorted(
        ("user_1\t", line.replace("→", "\t") + "\t") for line in EVENTS[:2])
    assert rows(readers.parse_wire(wire).rows) == rows(readers.parse_events(lines(*EVENTS)).rows)


def test_wire_loses_one_tab_only(lines):
    wire = lines("u→ts→a→n→t→T→", "u→ts→a→n→→→", "u→ts→a→n→t→T", "u→ts→a→n→t→", "\n\n", "\nu→ts",
                 "u→ts→a→n→t→T→→")
    wire = wire.select(F.encode("value", "UTF-8").alias("value"))
    parsed = readers.parse_wire(wire)
    assert rows(parsed.rows.select("track_id", "track_name")) == [("", ""), ("t", "T"), ("t", "T")]
    assert sorted(r.value for r in parsed.rejects.collect()) == [
        "u\tts\ta\tn\tt\t", "u\tts\ta\tn\tt\tT\t\t"]


def test_each_line_is_split_once(lines, capsys):
    readers.parse_users(lines("a")).rows.explain()
    assert capsys.readouterr().out.count("split(") == 1


def test_files_by_glob(spark, lines, tmp_path):
    lines("u1→m→22→Japan→x").write.text(str(tmp_path / "a"))
    lines("u2→m→22→Japan→x").write.text(str(tmp_path / "b"))
    assert readers.read_users(spark, str(tmp_path / "*")).rows.count() == 2


def test_users_of_an_imported_table(spark):
    table = spark.createDataFrame(
        [(1, "m", 22, "Japan", "x"), (2, "f", None, "Peru", "x\ty"), (3, "f", 30, "Chile", None),
         (4, None, None, None, None)],
        "id int, gender string, age int, since string, note string")
    parsed = readers.users_of_table(table)
    assert sorted((r.user_id, r.age, r.extra) for r in parsed.rows.collect()) == [("1", 22, "x"), ("2", None, "x\ty")]
    assert sorted(r.reason for r in parsed.rejects.collect()) == [
        "Error en Usuario, tamaño: 1", "Error en Usuario, tamaño: 4"]
