import json

from tidemark.__main__ import main
from tidemark.session import shared_dir
from workload import inputs as i
from workload.inputs import Tables


def test_full_load_from_csv_files(spark, folder, capsys):
    base = f"{shared_dir(spark)}/exports"
    for name, df in i.sheets(Tables(spark, folder)).items():
        decorated = df.toDF(*(c.replace("_", " ").title() for c in df.columns))
        decorated.write.option("header", True).csv(f"{base}/{name}.csv")
    arguments = ["cli_test", base, "--load-ts", "2025-01-01T08:00:00"]
    assert main(arguments) == 0
    result = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert result["status"] == result["mart_status"] == "OK" and len(result["refreshed"]) == 7
    assert spark.table("cli_test.mv_sales_datamart_all_joint").count() > 0

    sales = i.sheets(Tables(spark, folder))["Sales_data"].orderBy("salesorderlinekey").drop("update_ts")
    stored = spark.table("cli_test.src_sales_data").orderBy("salesorderlinekey").drop("update_ts")
    assert sales.collect() == stored.collect()
