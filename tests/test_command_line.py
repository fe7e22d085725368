from shiftpay.__main__ import main
from shiftpay.sources import sinks

EMPLOYEES = """employee_id,first_name,last_name,department,pay_rate,hire_date,status,email
E1,Ann,Lee,A,20.00,2020-01-01,Active,a@example.org
E1,Bob,Lee,A,25.00,2020-01-01,Active,a@example.org
"""
LOGS = """log_id,employee_id,clock_in,clock_out,department,pay_rate,log_date
L1,E1,2024-01-03 08:00:00,2024-01-03 18:00:00,A,20.00,2024-01-03
L1,E1,2024-01-03 08:00:00,2024-01-03 18:00:00,A,20.00,2024-01-03
L2,E1,2024-01-04 08:00:00,,A,20.00,2024-01-04
"""


def test_run_and_report(spark, tmp_path, capsys):
    (tmp_path / "employees.csv").write_text(EMPLOYEES)
    (tmp_path / "logs.csv").write_text(LOGS)
    tables = str(tmp_path / "tables")
    files = [str(tmp_path / "employees.csv"), str(tmp_path / "logs.csv")]
    main(["run", *files, tables, "--csv", "--warehouse", str(tmp_path / "warehouse")])
    assert "SUCCESS" in capsys.readouterr().out
    person = sinks.employees(spark, tables).first()
    assert (person.first_name, float(person.pay_rate)) == ("Ann", 25.0)
    reasons = {(r.log_id, r.error_reason) for r in sinks.validation_errors(spark, tables).collect()}
    assert reasons == {("L1", "DUPLICATE_RECORD"), ("L2", "MISSING_CLOCK_OUT")}
    main(["report", tables])
    assert "220.00" in capsys.readouterr().out


def test_follow(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "1.csv").write_text(LOGS)
    tables, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    main(["follow", str(raw), tables, checkpoint])
    (raw / "2.csv").write_text(LOGS.replace("L2", "L3"))
    main(["follow", str(raw), tables, checkpoint])
    assert sinks.time_logs(spark, tables).count() == 1
    assert sinks.validation_errors(spark, tables).count() == 5
