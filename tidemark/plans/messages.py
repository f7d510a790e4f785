"""Texts of the audit log."""

# Names and messages under which the steps of a run are recorded.
LOAD = "load {table}"
LOADED = "{table} loaded successfully"
LOAD_FAILED = "Failed to load {table}: {error}"
ALL_SHEETS = "initial_temp_load_all_sheets"
ALL_SHEETS_OK = "initial temp load completed successfully"
ALL_SHEETS_FAILED = "one or more temp tables failed to load"
FULL_RUN = "initial_full_load_pipeline"
FULL_RUN_OK = "initial load + upload_src completed successfully"
FULL_RUN_FAILED = "one or more steps failed during initial load or upload_src"

UPLOAD = "fn_upload_src"
REFRESH_DIMS = "sp_refresh_dims"
REFRESH_FACT = "sp_refresh_fct"
REFRESH_MART = "sp_refresh_sales_datamart"
EXECUTION_STARTED = "{procedure} execution started"
UPLOADED = "{table} uploaded successfully"
UPLOAD_FAILED = "upload failed: {error}"
PROCEDURE_OK = "procedure completed successfully"
PHASES_FAILED = "one or more phases failed"
BRANCH_FAILED = "branch failed"
STEPS_FAILED = "one or more steps failed"
UNSUPPORTED = "unsupported table name: {table}"
NO_NAME = "<NULL>"
UPLOAD_COMPLETED = "fn_upload_src completed successfully"
UPLOAD_PROCEDURE_FAILED = "fn_upload_src failed: {error}"
MART_OK = "Sales datamart refreshed successfully"
MART_FAILED = "Refresh failed: {error}"
MART_COMPLETED = "sp_refresh_sales_datamart completed"
MART_PROCEDURE_FAILED = "sp_refresh_sales_datamart failed: {error}"

# Of bad rows that were set aside; recorded only if this was asked for.
REJECT = "reject rows of {table}"
REJECTED = "{rows} rows set aside in {rejected}"
