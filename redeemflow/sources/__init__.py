from redeemflow.sources.log import (  # noqa: F401
    LOG_SCHEMA,
    ONLINE_SCHEMA,
    TEST_LOG_SCHEMA,
    coupon_log,
    coupon_view,
    malformed,
    materialize_log,
    log_table_path,
    offline_test,
    open_bucketed,
    read_by_day,
    read_log_checked,
    read_log_csv,
    read_online_csv,
    read_matrix_csv,
    stored_table,
    write_bucketed,
    write_by_day,
    write_csv,
)
