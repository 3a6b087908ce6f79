"""What the column catalog must say, row by row: printed once from the declarations, then read through; fixed since."""

# Table, its meaning, column, place, type, may be null, default, meaning.
CATALOG_ROWS = """
    ('data_lineage', 'ETL job execution tracking and audit trail', 'lineage_id', 1, 'string', false, NULL, 'Column: lineage_id'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'source_system', 2, 'string', false, NULL, 'Column: source_system'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'source_table', 3, 'string', false, NULL, 'Column: source_table'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'source_file', 4, 'string', true, NULL, 'Column: source_file'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'target_table', 5, 'string', false, NULL, 'Column: target_table'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'etl_job_name', 6, 'string', false, NULL, 'Column: etl_job_name'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'batch_id', 7, 'string', false, NULL, 'Column: batch_id'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'records_processed', 8, 'bigint', false, NULL, 'Column: records_processed'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'records_inserted', 9, 'bigint', false, NULL, 'Column: records_inserted'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'records_updated', 10, 'bigint', false, NULL, 'Column: records_updated'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'records_rejected', 11, 'bigint', false, '0', 'Column: records_rejected'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'start_time', 12, 'timestamp_ntz', false, NULL, 'Column: start_time'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'end_time', 13, 'timestamp_ntz', false, NULL, 'Column: end_time'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'duration_seconds', 14, 'int', false, NULL, 'Column: duration_seconds'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'status', 15, 'string', false, NULL, 'Column: status'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'error_message', 16, 'string', true, NULL, 'Column: error_message'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'job_metadata', 17, 'string', true, NULL, 'Column: job_metadata'),
    ('data_lineage', 'ETL job execution tracking and audit trail', 'created_at', 18, 'timestamp_ntz', true, 'load time', 'Column: created_at'),
    ('data_quality_alerts', 'Table: data_quality_alerts', 'alert_time', 1, 'timestamp_ntz', true, 'load time', 'Column: alert_time'),
    ('data_quality_alerts', 'Table: data_quality_alerts', 'severity', 2, 'string', true, NULL, 'Column: severity'),
    ('data_quality_alerts', 'Table: data_quality_alerts', 'message', 3, 'string', true, NULL, 'Column: message'),
    ('data_quality_alerts', 'Table: data_quality_alerts', 'metadata', 4, 'string', true, NULL, 'Column: metadata'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'metric_id', 1, 'string', false, NULL, 'Column: metric_id'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'table_name', 2, 'string', false, NULL, 'Column: table_name'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'column_name', 3, 'string', true, NULL, 'Column: column_name'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'metric_name', 4, 'string', false, NULL, 'Column: metric_name'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'metric_value', 5, 'decimal(15,4)', false, NULL, 'Column: metric_value'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'threshold_value', 6, 'decimal(15,4)', true, NULL, 'Column: threshold_value'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'is_threshold_met', 7, 'boolean', true, NULL, 'Column: is_threshold_met'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'batch_id', 8, 'string', false, NULL, 'Column: batch_id'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'measured_at', 9, 'timestamp_ntz', false, 'load time', 'Column: measured_at'),
    ('data_quality_metrics', 'Data quality measurements and monitoring', 'details', 10, 'string', true, NULL, 'Column: details'),
    ('data_versions', 'Table: data_versions', 'version_id', 1, 'int', false, NULL, 'Column: version_id'),
    ('data_versions', 'Table: data_versions', 'version_number', 2, 'string', false, NULL, 'Column: version_number'),
    ('data_versions', 'Table: data_versions', 'version_type', 3, 'string', true, 'INCREMENTAL', 'Column: version_type'),
    ('data_versions', 'Table: data_versions', 'description', 4, 'string', true, NULL, 'Column: description'),
    ('data_versions', 'Table: data_versions', 'source_file', 5, 'string', true, NULL, 'Column: source_file'),
    ('data_versions', 'Table: data_versions', 'file_hash', 6, 'string', true, NULL, 'Column: file_hash'),
    ('data_versions', 'Table: data_versions', 'etl_job_id', 7, 'string', true, NULL, 'Column: etl_job_id'),
    ('data_versions', 'Table: data_versions', 'status', 8, 'string', true, NULL, 'Column: status'),
    ('data_versions', 'Table: data_versions', 'records_count', 9, 'bigint', true, NULL, 'Column: records_count'),
    ('data_versions', 'Table: data_versions', 'created_at', 10, 'timestamp_ntz', true, 'load time', 'Column: created_at'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'customer_key', 1, 'bigint', false, 'next key', 'Surrogate primary key'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'customer_id', 2, 'string', true, NULL, 'Business customer identifier'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'country', 3, 'string', true, NULL, 'Customer country'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'effective_date', 4, 'timestamp_ntz', true, NULL, 'Column: effective_date'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'expiry_date', 5, 'timestamp_ntz', true, NULL, 'Column: expiry_date'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'version_id', 6, 'int', true, NULL, 'Column: version_id'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'version_created_at', 7, 'timestamp_ntz', true, NULL, 'Column: version_created_at'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'is_current', 8, 'boolean', true, NULL, 'Current record flag for SCD Type 2'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'created_at', 9, 'timestamp_ntz', true, NULL, 'Column: created_at'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'updated_at', 10, 'timestamp_ntz', true, NULL, 'Column: updated_at'),
    ('dim_customer', 'Customer dimension with SCD Type 2 for tracking changes', 'data_source', 11, 'string', true, NULL, 'Column: data_source'),
    ('dim_date', 'Date dimension for time-based analysis', 'date_key', 1, 'int', false, NULL, 'Column: date_key'),
    ('dim_date', 'Date dimension for time-based analysis', 'date_value', 2, 'date', false, NULL, 'Column: date_value'),
    ('dim_date', 'Date dimension for time-based analysis', 'year', 3, 'int', true, NULL, 'Column: year'),
    ('dim_date', 'Date dimension for time-based analysis', 'quarter', 4, 'int', true, NULL, 'Column: quarter'),
    ('dim_date', 'Date dimension for time-based analysis', 'month', 5, 'int', true, NULL, 'Column: month'),
    ('dim_date', 'Date dimension for time-based analysis', 'week', 6, 'int', true, NULL, 'Column: week'),
    ('dim_date', 'Date dimension for time-based analysis', 'day_of_year', 7, 'int', true, NULL, 'Column: day_of_year'),
    ('dim_date', 'Date dimension for time-based analysis', 'day_of_month', 8, 'int', true, NULL, 'Column: day_of_month'),
    ('dim_date', 'Date dimension for time-based analysis', 'day_of_week', 9, 'int', true, NULL, 'Column: day_of_week'),
    ('dim_date', 'Date dimension for time-based analysis', 'month_name', 10, 'string', true, NULL, 'Column: month_name'),
    ('dim_date', 'Date dimension for time-based analysis', 'day_name', 11, 'string', true, NULL, 'Column: day_name'),
    ('dim_date', 'Date dimension for time-based analysis', 'quarter_name', 12, 'string', true, NULL, 'Column: quarter_name'),
    ('dim_date', 'Date dimension for time-based analysis', 'is_weekend', 13, 'boolean', true, NULL, 'Column: is_weekend'),
    ('dim_date', 'Date dimension for time-based analysis', 'is_holiday', 14, 'boolean', true, NULL, 'Column: is_holiday'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'product_key', 1, 'bigint', false, 'next key', 'Surrogate primary key'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'stock_code', 2, 'string', true, NULL, 'Business product identifier'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'description', 3, 'string', true, NULL, 'Product description'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'version_id', 4, 'int', true, NULL, 'Column: version_id'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'version_created_at', 5, 'timestamp_ntz', true, NULL, 'Column: version_created_at'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'category', 6, 'string', true, NULL, 'Column: category'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'subcategory', 7, 'string', true, NULL, 'Column: subcategory'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'is_active', 8, 'boolean', true, 'true', 'Column: is_active'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'is_gift', 9, 'boolean', true, 'false', 'Column: is_gift'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'created_at', 10, 'timestamp_ntz', true, NULL, 'Column: created_at'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'updated_at', 11, 'timestamp_ntz', true, NULL, 'Column: updated_at'),
    ('dim_product', 'Product master data with SCD Type 1 implementation', 'data_source', 12, 'string', true, NULL, 'Column: data_source'),
    ('dim_transaction_type', 'Table: dim_transaction_type', 'transaction_type', 1, 'string', false, NULL, 'Column: transaction_type'),
    ('dim_transaction_type', 'Table: dim_transaction_type', 'effect_sign', 2, 'smallint', false, NULL, 'Column: effect_sign'),
    ('dim_transaction_type', 'Table: dim_transaction_type', 'description', 3, 'string', false, NULL, 'Column: description'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'sales_key', 1, 'bigint', false, 'next key', 'Surrogate primary key'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'date_key', 2, 'int', false, NULL, 'Foreign key to dim_date'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'version_id', 3, 'int', true, NULL, 'Column: version_id'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'version_created_at', 4, 'timestamp_ntz', true, NULL, 'Column: version_created_at'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'customer_key', 5, 'bigint', false, NULL, 'Foreign key to dim_customer'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'product_key', 6, 'bigint', false, NULL, 'Foreign key to dim_product'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'invoice_no', 7, 'bigint', false, NULL, 'Business invoice number'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'transaction_type', 8, 'string', false, NULL, 'SALE or RETURN'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'quantity', 9, 'int', false, NULL, 'Number of items sold'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'unit_price', 10, 'decimal(10,2)', false, NULL, 'Price per unit'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'line_total', 11, 'decimal(15,2)', false, NULL, 'Total line amount (quantity * unit_price)'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'transaction_datetime', 12, 'timestamp_ntz', false, NULL, 'Column: transaction_datetime'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'created_at', 13, 'timestamp_ntz', false, NULL, 'Column: created_at'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'batch_id', 14, 'string', true, NULL, 'ETL batch identifier'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'data_source', 15, 'string', false, NULL, 'Column: data_source'),
    ('fact_sales', 'Core sales transactions with foreign keys to dimension tables', 'txn_year', 16, 'int', true, NULL, 'Column: txn_year'),
    ('fact_sales_archive', 'Table: fact_sales_archive', 'sales_key', 1, 'bigint', false, NULL, 'Column: sales_key'),
    ('fact_sales_archive', 'Table: fact_sales_archive', 'operation', 2, 'string', false, NULL, 'Column: operation'),
    ('fact_sales_archive', 'Table: fact_sales_archive', 'version_id', 3, 'int', true, NULL, 'Column: version_id'),
    ('fact_sales_archive', 'Table: fact_sales_archive', 'changed_at', 4, 'timestamp_ntz', false, 'load time', 'Column: changed_at'),
    ('fact_sales_archive', 'Table: fact_sales_archive', 'changed_by', 5, 'string', true, NULL, 'Column: changed_by'),
    ('fact_sales_archive', 'Table: fact_sales_archive', 'payload', 6, 'string', false, NULL, 'Column: payload')
"""
