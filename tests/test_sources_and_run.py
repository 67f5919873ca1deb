import hashlib
import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import RunConfig
from ledgerloom.plans import reconcile as R
from ledgerloom.sources import normalise, registry, sinks
from ledgerloom.sources.workspace import settle, shared_root

BANNER = "Earnings report (merchant account: acc). All dates and times are in America/Los_Angeles."


def write(folder, name, data):
    path = folder / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return f"file://{path}"


FILES = {  # name -> (bytes, declared, encoding used, line ends stripped, lines, composed)
    "plain": (b"a,b\n1,2\n", "cp1252", "utf-8", 0, 2, False),
    "western": ("n;v\nJürgen €;1\n".encode("cp1252"), "cp1252", "cp1252", 0, 2, False),
    "already": ("n;v\nJürgen;1\n".encode(), "cp1252", "utf-8", 0, 2, False),
    "marked": ("n;v\nJürgen;1\n".encode("utf-8-sig"), "cp1252", "utf-8-sig", 0, 2, False),
    "wide16": ("n;v\r\nJürgen;1\r\n".encode("utf-16"), "utf-8", "utf-16", 2, 2, False),
    "wide32": ("n;v\nJürgen;1".encode("utf-32"), "utf-8", "utf-32", 0, 1, False),
    "mixed": (b"banner\nn;v\r\nx;1\r\n", "utf-8", "utf-8", 2, 3, False),
    "decomposed": (unicodedata.normalize("NFD", "n;v\nJürgen;1\n").encode(), "utf-8", "utf-8", 0, 2, True),
    "inner_return": (b"a\rb\nc", "utf-8", "utf-8", 0, 1, False)}


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    folders = {n: (write(folder, f"{n}.csv", f[0]), f[1]) for n, f in FILES.items()}
    folders["empty"] = (write(folder, "empty.csv", b""), "utf-8")
    folders["broken"] = (write(folder, "broken.csv", "Jürgen\n".encode("cp1252")), "utf-8")
    folders["undefined"] = (write(folder, "undefined.csv", b"\x81\xfc\n"), "cp1252")
    files = settle(normalise.fingerprints(spark, folders), "fingerprints")
    return files, normalise.normalised_lines(spark, files)


def test_manifest(ingested):
    rows = {r.source: r for r in normalise.manifest(*ingested).collect()}
    for name, (data, declared, used, crlf, lines, composed) in FILES.items():
        r = rows[name]
        assert (r.declared, r.encoding_used, r.crlf_stripped, r.lines, r.nfc_changed) == (declared, used, crlf, lines, composed), name
        assert (r.sha256_in, r.bytes_in, r.decodable) == (hashlib.sha256(data).hexdigest(), len(data), True)


def test_lines_are_clean(ingested):
    got = {}
    for r in ingested[1].collect():
        got.setdefault(r.source, []).append(r.line)
    assert got["western"] == ["n;v", "Jürgen €;1"]
    for name in ("already", "marked", "wide16", "wide32", "decomposed"):
        assert got[name] == ["n;v", "Jürgen;1"], name
    assert got["mixed"] == ["banner", "n;v", "x;1"] and got["inner_return"] == ["a\rb", "c"]
    assert "broken" not in got and "undefined" not in got and "empty" not in got


def test_quarantine(ingested):
    faults = {(r.source, r.fault) for r in normalise.input_faults(ingested[0], ["plain", "absent", "empty"]).collect()}
    assert faults == {("absent", "missing"), ("empty", "missing"), ("broken", "undecodable"), ("undefined", "undecodable")}
    with pytest.raises(ValueError, match="absent missing"):
        normalise.require_inputs(ingested[0], ["absent"])
    normalise.require_inputs(ingested[0].filter("decodable"), ["plain"])


def test_source_dialects(spark, tmp_path):
    google = write(tmp_path, "g.csv", f'{BANNER}\nDate,Amount\r\n"Jul 1, 2026",1.00\r\n"Jul 2, 2026",\r\n')
    semi = write(tmp_path, "s.csv", "a;b\n1,5;x\n")
    specs = registry.registry({"google_play_earnings": google, "paypal_eu_activity": semi})
    assert [tuple(r) for r in registry.read_source(spark, specs["google_play_earnings"]).collect()] == [
        ("Jul 1, 2026", "1.00"), ("Jul 2, 2026", None)]
    assert [tuple(r) for r in registry.read_source(spark, specs["paypal_eu_activity"]).collect()] == [("1,5", "x")]
    assert registry.register_views(spark, specs) == ["google_play_earnings", "paypal_eu_activity"]
    assert spark.sql("select count(*) from paypal_eu_activity").first()[0] == 1


def test_parts_are_stacked_by_name(spark, tmp_path):
    one, two = write(tmp_path, "1.csv", "a,b\n1,2\n"), write(tmp_path, "2.csv", "b,a\n4,3\n")
    specs = registry.registry({"fx_rates:1": one, "fx_rates:2": two})
    assert sorted(tuple(r) for r in registry.read_parts(spark, specs.values()).collect()) == [("1", "2"), ("3", "4")]


def test_a_folder_of_files_with_unlike_headers_is_refused(spark, tmp_path):
    write(tmp_path, "1.csv", "a,b\n1,2\n")
    write(tmp_path, "2.csv", "a,b\n3,4\n")
    specs = registry.registry({"fx_rates": f"file://{tmp_path}"})
    assert sorted(tuple(r) for r in registry.read_source(spark, specs["fx_rates"]).collect()) == [("1", "2"), ("3", "4")]
    write(tmp_path, "3.csv", "b,a\n5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        registry.read_source(spark, specs["fx_rates"]).collect()


class Cluster:
    """As much of a session as the choice of folder looks at."""

    class sparkContext:
        applicationId, master = "app", "spark://host"

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_root(Cluster(**{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(ValueError, match="shared folder"):
        shared_root(Cluster())  # never a folder of one machine on a cluster


def test_settled_tables_read_back_equal(spark):
    df = spark.range(5).select("id", F.lit("x").alias("a column (odd)"))
    assert settle(df, "x").exceptAll(df).count() == 0 and settle(df, "x").count() == 5


def test_export_is_one_ordered_file(spark, tmp_path):
    df = spark.range(100).select(F.lit("2026-06-01").alias("reporting_month"), F.lit("p").alias("psp"),
                                 (F.col("id") * 37 % 100).alias("line_seq")).repartition(7)
    path = sinks.export_csv(df, f"file://{tmp_path}", "recon_waterfall", sinks.waterfall_order(), date(2026, 6, 1))
    assert path.endswith("recon_waterfall_2026-06.csv")
    assert sinks.export_csv(df, f"file://{tmp_path}", "recon_waterfall", sinks.waterfall_order(), date(2026, 6, 1)) == path
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith(".")] == ["recon_waterfall_2026-06.csv"]
    lines = (tmp_path / "recon_waterfall_2026-06.csv").read_text().split()
    assert lines[0] == "reporting_month,psp,line_seq" and [int(x.split(",")[2]) for x in lines[1:]] == list(range(100))


LOG = """txn_id,order_id,operation_type,status,psp,psp_reference,sku,country,currency,amount_local,fx_rate_applied,fx_date_applied,amount_usd,created_at_utc,captured_at_utc
T1,O1,SALE,settled,adyen,P1,sub_monthly,DE,EUR,58.40,1.08,2026-06-26,63.07,2026-06-28 10:00:00,2026-06-28 10:00:00
T2,O2,SALE,settled,dlocal,D2,sub_monthly,BR,BRL,19.90,1,2026-06-10,19.90,2026-06-10 00:00:00,2026-06-10 00:00:05
T3,O3,SALE,settled,google_play,,sub_monthly,DE,EUR,9.99,1.08,2026-06-30,10.79,2026-07-01 10:50:00,2026-07-01 10:50:07
T4,O4,SALE,pending,paypal_us,A4,sub_monthly,US,USD,24.99,1,2026-06-12,24.99,2026-06-12 10:00:00,
T5,O5,SALE,settled,paypal_eu,B5,sub_monthly,DE,EUR,10.00,1.08,2026-06-05,10.80,2026-06-05 09:59:00,2026-06-05 10:00:00
T6,O6,SALE,declined,google_play,,sub_monthly,DE,EUR,9.99,1.08,2026-06-30,10.79,2026-06-30 10:50:00,
T7,O7,SALE,settled,other_psp,Z7,sub_monthly,DE,EUR,9.99,1.08,2026-06-30,10.79,2026-06-30 10:50:00,2026-06-30 10:50:00
"""
EXPORTS = {
    "payment_engine_log": LOG,
    "adyen_payment_accounting": (
        "Merchant Account,Psp Reference,Merchant Reference,Record Type,Creation Date,Gross Currency,Gross Credit,Gross Debit,"
        "Commission,Markup,Net Currency,Net Credit,Net Debit,Batch Number\n"
        "EU,P1,O1,Authorised,2026-06-28 12:00:00,EUR,58.40,,,,EUR,,,26\nEU,P1,O1,Settled,2026-06-28 12:00:00,EUR,36.00,,0.60,0.30,EUR,35.10,,26\n"),
    "dlocal_transactions": (
        "transaction_id,invoice_id,transaction_type,status,created_at_utc,country,currency,currency_exponent,local_amount,fx_rate,usd_amount,fee_usd\n"
        + "D2,O2,PAYMENT,PAID,2026-06-10 00:00:05,BR,BRL,2,1990,5.263158,3.78,0.17\n" * 2),
    "google_play_earnings:202606": f'{BANNER}\nTransaction Date,Transaction Time,Transaction Type,Product ID,Buyer Country,Buyer Currency,'
        'Amount (Buyer Currency),Currency Conversion Rate,Merchant Currency,Amount (Merchant Currency)\r\n'
        '"Jul 1, 2026",03:50:07,Charge,sub_monthly,DE,EUR,9.99,1.08,USD,10.79\r\n',
    "google_play_earnings:202607_partial": f'{BANNER}\nTransaction Date,Transaction Time,Transaction Type,Product ID,Buyer Country,Buyer Currency,'
        'Amount (Buyer Currency),Currency Conversion Rate,Merchant Currency,Amount (Merchant Currency)\r\n'
        '"Jul 1, 2026",03:50:07,Google fee,sub_monthly,DE,EUR,-1.50,1.08,USD,-1.62\r\n',
    "paypal_us_activity": "Date,Time,Time Zone,Name,Type,Status,Currency,Gross,Fee,Net,Transaction ID,Reference Txn ID,Invoice ID\n"
        "06/12/2026,10:00:00,GMT,Ann,Website Payment,Completed,USD,24.99,-1.36,23.63,A4,,O4\n",
    "paypal_eu_activity": "Date;Time;Time Zone;Name;Type;Status;Currency;Gross;Fee;Net;Transaction ID;Reference Txn ID;Invoice ID\n"
        "05/06/2026;10:00:00;GMT;Jürgen;Website Payment;Completed;EUR;10,00;-0,64;9,36;B5;;O5\n"
        "06/15/2026;10:00:00;GMT;José;Payment Reversal;Reversed;EUR;-5,00;0,00;-5,00;C9;B5;O5\n",
    "fx_rates": "rate_date,currency,usd_rate,published_at\n2026-06-01,EUR,1.08,2026-06-01T16:00:00Z\n"
        "2026-06-05,EUR,1.08,2026-06-05T16:00:00Z\n2026-06-26,EUR,1.08,2026-06-26T16:00:00Z\n2026-06-30,EUR,1.08,2026-06-30T16:00:00Z\n"
        "2026-06-10,BRL,0.18,2026-06-10T16:00:00Z\n2026-06-10,BRL,0.19,2026-06-12T16:00:00Z\n",
    "fee_schedule": "psp,account,valid_from,percent_fee,fixed_fee,fixed_fee_currency\nadyen,EU,2026-01-01,2.5,0.00,\ngoogle_play,play_main,2026-01-01,15.0,0.00,\n"}


def exports(folder):
    return {name: write(folder, name.replace(":", "_") + ".csv", text.encode("cp1252" if name == "paypal_eu_activity" else "utf-8"))
            for name, text in EXPORTS.items()}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    config = RunConfig(reporting_month=date(2026, 6, 1), export_window=(date(2026, 6, 1), date(2026, 7, 3)),
                       output_dir=f"file://{folder}/out", expected_date_overrides=("O5",))
    return R.reconcile(spark, exports(folder), config)


def test_run_classifies_every_row(run):
    causes = {r.order_ref or r.match_key: r.gross_cause for r in run.tables["classified"].filter("operation_type = 'sale'").collect()}
    assert causes == {
        "O1": "psp_claims_partial_capture", "O2": "psp_claims_duplicate_row", "O3": "matched", "O4": "engine_capture_not_recorded",
        "O5": "matched", "O6": "psp_claims_captured_different_period"}  # O7: no export of that provider
    back = run.tables["classified"].filter("operation_type = 'chargeback'").first()
    assert (back.gross_cause, str(back.gross_diff_usd)) == ("psp_claims_chargeback", "-5.40")
    bugs = {r.txn_id: r.fx_variance_reason for r in run.tables["restated"].collect()}
    assert bugs["T2"] == "fx_not_applied" and bugs["T1"] == "none"


def test_run_reports_and_exports(spark, run):
    waterfall = {(r.psp, r.line_item): str(r.usd) for r in run.tables["waterfall"].collect()}
    assert waterfall["dlocal", "backend_booked"] == "19.90" and waterfall["dlocal", "backend_fx_faults"] == "-16.12"
    assert waterfall["dlocal", "provider_gross"] == "7.56"
    written = spark.read.option("header", True).csv(run.files["summary"])
    assert written.count() == run.tables["summary"].count() and "recon_summary_2026-06" in run.files["summary"]
    used = {r.source: r.encoding_used for r in run.tables["manifest"].collect()}
    assert used["paypal_eu_activity"] == "cp1252" and used["paypal_us_activity"] == "utf-8"


def test_checks_of_the_run(run):
    failing = {name.removeprefix("check_"): df.count() for name, df in run.tables.items() if name.startswith("check_")}
    assert len(failing) > 30
    # T6 never captured and so has no match key; T7 names a provider that is not on the list
    assert {n: rows for n, rows in failing.items() if rows} == {"columns_matched": 1, "columns_ledger": 1}
    assert run.failed == ["columns_ledger", "columns_matched"]
    assert {r.check: r.violations for r in run.tables["violations"].collect()} == failing


def test_missing_input_stops_the_run(spark, tmp_path):
    paths = exports(tmp_path)
    del paths["fx_rates"]
    with pytest.raises(ValueError, match="missing inputs: fx_rates"):
        R.reconcile(spark, paths, RunConfig(export_window=(date(2026, 6, 1), date(2026, 7, 3))))


def test_each_file_of_a_folder_is_read_by_its_own_header(spark, tmp_path):
    """Unlike headers, a data line that spells a header, and a path that isn't there."""
    (tmp_path / "rates").mkdir()
    write(tmp_path / "rates", "one.csv", b"a,b\n1,2\na,b\n")
    write(tmp_path / "rates", "two.csv", b"b,a\n4,3\n")
    folders = {"rates": (f"file://{tmp_path}/rates", "utf-8"), "gone": (f"file://{tmp_path}/gone", "utf-8")}
    files = settle(normalise.fingerprints(spark, folders), "fingerprints")
    parsed = registry.parse_files(normalise.normalised_lines(spark, files), registry.SourceSpec("rates", ""))
    assert sorted((r.a, r.b) for r in parsed.collect()) == [("1", "2"), ("3", "4"), ("a", "b")]
    with pytest.raises(ValueError, match="1 quarantined inputs.*gone missing"):
        normalise.require_inputs(files, ["rates", "gone"])
