"""Large CSV files are cut into records block by block, whatever lies across the borders of blocks."""

import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relata.operators import validation
from relata.sources import csv_files
from relata.sources.contracts import CONTRACTS
from relata.sources.csv_blocks import BlockFiles, Dialect, cut, surveyed

LEADS = CONTRACTS["crm_new_partner_leads"]
HEADER = "external_lead_id,email,partner_name,lead_score,utm_source,created_at,opt_in"


@pytest.fixture(params=[300, 4096])
def small_blocks(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def field(rnd):
    parts = ["plain", "é", '""', ",", "\n", "\r\n", "x" * 40, " "]
    text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(5)))
    return f'"{text}"' if rnd.random() < 0.9 or set(text) & set(',\n\r"') else text


def written(rnd, count, end):
    rows = [f"L{i},{i}@b.co," + ",".join(field(rnd) for _ in range(5)) for i in range(count)]
    for place in range(5, count, 9):
        rows[place] += end
    rows[count // 2] = f'L{count // 2},{count // 2}@b.co,"' + "long value, \n" * 90 + '",1,,,'
    return HEADER + end + end.join(rows) + end


def expected(text):
    """The records that the csv module reads, with what the scan makes of them: empty fields, numbers from 2."""
    reader = csv.reader(io.StringIO(text, newline=""))
    header = next(reader)
    rows = [row for row in reader if row]
    return header, [(number, *[value or None for value in row[: len(header)]]) for number, row in enumerate(rows, 2)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_of_many_blocks(spark, tmp_path, small_blocks, end):
    text = written(random.Random(small_blocks), 200, end)
    (tmp_path / "crm_new_partner_leads_a.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    df = csv_files.read_crm_csv(spark, str(tmp_path), LEADS)
    files = BlockFiles(spark, [str(tmp_path / "crm_new_partner_leads_a.csv")], Dialect(",", '"'))
    assert files.blocks.count() > 3 and files.blocks.where("end = 1").count() > 0
    names = [validation.NUMBER, *LEADS.names]
    found = sorted(tuple(value or None for value in row) for row in df.select(*names).collect())
    assert found == expected(text)[1]
    # Offsets are those of the bytes after the mark.
    raw = text.encode()
    for row in df.select(validation.OFFSET, "external_lead_id").collect():
        assert raw[row[0] :].startswith(row[1].encode() + b",")


def test_files_with_other_headers_and_sizes(spark, tmp_path, small_blocks):
    rnd = random.Random(4)
    wanted = {}
    for i in range(6):
        columns = HEADER.split(",")
        rnd.shuffle(columns)
        columns = columns[: rnd.randint(4, 7)]
        if i == 3:
            columns[1] = "a\nnote" * 200
        rows = [[f"{i}-{n}-{c}" + ("\n" if n % 3 else "") for c in range(len(columns))] for n in range(rnd.choice([0, 1, 60]))]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n").writerows([columns, *rows])
        (tmp_path / f"crm_new_partner_leads_{i} x.csv").write_text(out.getvalue())
        for n, row in enumerate(rows, 2):
            held = dict(zip(columns, row, strict=True))
            wanted[f"{i} x.csv", n] = [held.get(name) for name in LEADS.names]
    (tmp_path / "crm_new_partner_leads_empty.csv").write_text("")
    df = csv_files.read_crm_csv(spark, str(tmp_path), LEADS)
    found = {(r[0].rsplit("_", 1)[-1].replace("%20", " "), r[1]): list(r)[2:] for r in df.select(validation.FILE, validation.NUMBER, *LEADS.names).collect()}
    assert found == wanted


def test_an_unclosed_quote_runs_to_the_end_of_its_file(spark, tmp_path, small_blocks):
    (tmp_path / "crm_new_partner_leads_a.csv").write_text(HEADER + '\nL1,a@b.co,"open\n' + "more,\n" * 400)
    (tmp_path / "crm_new_partner_leads_b.csv").write_text(HEADER + "\nL2,b@b.co\n")
    found = {r.external_lead_id: r.partner_name for r in csv_files.read_crm_csv(spark, str(tmp_path), LEADS).collect()}
    assert set(found) == {"L1", "L2"} and found["L1"].startswith("open\nmore,\nmore")


def test_without_multi_line_every_line_is_a_record(spark, tmp_path, small_blocks):
    lines = ["external_lead_id,email"] + [f'L{i},"x{i}@b.co' for i in range(3000)]
    (tmp_path / "crm_new_partner_leads_big.csv").write_text("\n".join(lines) + "\n")
    scanned = csv_files.read_crm_csv(spark, str(tmp_path), LEADS, multi_line=False)
    wrong = scanned.where(F.col(validation.NUMBER) != F.substring("external_lead_id", 2, 9).cast("bigint") + 2)
    assert scanned.count() == 3000 and wrong.count() == 0


def test_a_changed_split_is_noticed(spark, tmp_path):
    (tmp_path / "crm_new_partner_leads_a.csv").write_text(HEADER + "\n" + "L1,a@b.co\n" * 900)
    df = csv_files.read_crm_csv(spark, str(tmp_path), LEADS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        with pytest.raises(Exception, match="was not surveyed"):
            df.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_the_plan_cuts_records_without_a_shuffle_of_lines(spark, tmp_path):
    (tmp_path / "crm_new_partner_leads_a.csv").write_text(HEADER + "\n" + 'L1,a@b.co,"x\ny"\n' * 50)
    df = csv_files.read_crm_csv(spark, str(tmp_path), LEADS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def line_state(state, line):
    """Is a quoted value open after a line? Character by character."""
    mode = "in" if state else "start"
    for c in line:
        if mode == "in":
            mode = "quote" if c == '"' else "in"
        elif mode == "quote":
            mode = "in" if c == '"' else "start" if c == "," else "field"
        elif mode == "start":
            mode = "in" if c == '"' else "start" if c == "," else "field"
        elif c == ",":
            mode = "start"
    return int(mode == "in")


def test_states_of_random_lines():
    rnd, dialect = random.Random(1), Dialect(",", '"')
    for _ in range(4000):
        line = "".join(rnd.choice('a",') for _ in range(rnd.randrange(9)))
        for state in (0, 1):
            assert dialect.after(state, line.encode()) == line_state(state, line), (state, line)


def test_any_division_into_blocks_and_batches_gives_the_same_records():
    rnd, dialect = random.Random(2), Dialect(",", '"')
    for _ in range(60):
        lines = ["".join(rnd.choice(['a', '"', ",", '"b"', ""]) for _ in range(rnd.randrange(6))).encode() for _ in range(25)]
        borders = [0, *sorted(rnd.sample(range(1, 25), rnd.randrange(5))), 25]
        blocks = [(sum(len(x) + 1 for x in lines[:a]), lines[a:b]) for a, b in zip(borders[:-1], borders[1:], strict=True)]

        def batches(extra):
            for (start, held), more in zip(blocks, extra, strict=True):
                for low in range(0, len(held), 4):
                    part = held[low : low + 4]
                    columns = {"value": pa.array(part, pa.binary()), "_file": pa.array(["f"] * len(part)), "_block": pa.array([start] * len(part))}
                    columns |= {name: pa.array([value] * len(part), pa.int64()) for name, value in more.items()}
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        rows = [r for b in surveyed(batches([{}] * len(blocks)), dialect) for r in b.to_pylist()]
        state, before, offset, known = 0, 0, 0, []
        for row in rows:
            known.append({"state": state, "before": before, "offset": offset})
            before += row["count_in" if state else "count_out"]
            state, offset = row["end_in" if state else "end_out"], offset + row["bytes"]
        whole = [r for b in cut(batches(known), dialect, True) for r in b.to_pylist()]
        parts = [r for b in cut(batches(known), dialect, False) for r in b.to_pylist()]
        found = {r["number"]: r["text"] for r in whole}
        for part in sorted(parts, key=lambda r: r["piece"]):
            found[part["number"]] = b"\n".join([found[part["number"]], part["text"]]) if part["number"] in found else part["text"]
        state, wanted = 0, []
        for place, line in enumerate(lines):
            if state:
                wanted[-1] += b"\n" + line
            elif line or not place:
                wanted.append(line)
            state = line_state(state, line.decode())
        assert [found[n] for n in sorted(found)] == wanted and sorted(found) == list(range(1, len(wanted) + 1))


def test_no_task_sorts_the_lines_of_a_block(spark, tmp_path, small_blocks):
    """Also where nothing is small enough for a broadcast of Spark's own choice; the lines stay in order."""
    text = written(random.Random(5), 200, "\n")
    (tmp_path / "crm_new_partner_leads_a.csv").write_text(text)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = csv_files.read_crm_csv(spark, str(tmp_path), LEADS).select(validation.NUMBER, *LEADS.names)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Sort " not in plan
        assert sorted(tuple(value or None for value in row) for row in df.collect()) == expected(text)[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_numbers_are_counted_by_words_of_64(spark):
    def checked(numbers, other=(2, 3)):
        rows = [("a", n) for n in numbers] + [("b", n) for n in other]
        return tuple(validation.numbering(spark.createDataFrame(rows, f"{validation.FILE} string, {validation.NUMBER} bigint")).first())

    whole = list(range(2, 202))
    assert checked(whole) == (True, 202)
    # A number twice instead of another, a gap, another start.
    assert checked([*whole[:-2], 100, 201]) == (False, 202)
    assert checked([n for n in whole if n != 130]) == (False, 201)
    assert checked([n + 1 for n in whole]) == (False, 202)
    assert checked(whole, (3, 4)) == (False, 202)
    # What is shuffled are words, not records.
    df = validation.numbering(spark.createDataFrame([("a", 2)], f"{validation.FILE} string, {validation.NUMBER} bigint"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and "distinct" not in plan
