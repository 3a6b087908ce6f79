"""The sales view and the stages behind it, as SQL views for checking.

Plain SQL over the same tables. Each view names the views it reads; `query`
puts the ones a statement needs in front of it.
"""

import re

from tallyhouse.sources.testdata import CODES, LOADED_AT, SALES_AS_OF

_CODES = ", ".join(f"'{c}'" for c in CODES)


def _choose(number: str, cases: list[tuple[int, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {number} % {m} = 0 THEN {v}" for m, v in cases)
    return f"CASE {whens} ELSE {otherwise} END"


def _title(text: str) -> str:
    return (
        "coalesce(list_aggregate(list_transform("
        f"regexp_extract_all({text}, '[A-Za-z]+|[^A-Za-z]+'),"
        " lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', ''), '')"
    )


def _dated(layout: str, clock: str = "") -> str:
    return f"strftime(day, '{layout}')" + (f" || {clock}" if clock else "")


_HM = "' ' || hour || ':' || minute"

VIEWS = {
    "source_lines": """
        SELECT l.*, o.o_custkey AS custkey, n.n_name AS nation, p.p_name AS part_name,
               l_orderkey * 7 + l_partkey * 3 + l_linenumber AS d,
               CAST(l_quantity AS BIGINT) AS units_sold,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
               CAST(500000 + l_orderkey % 9000000 AS VARCHAR) AS number,
               l_returnflag = 'R' AS credit,
               CAST(o.o_orderdate AS DATE) + INTERVAL 15 YEAR AS day,
               CAST(8 + l_orderkey % 10 AS VARCHAR) AS hour,
               lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS minute
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
    "source_text": """
        SELECT *,
               CASE WHEN credit THEN 'C' ELSE '' END || number AS inv,
               l_partkey || chr(CAST(65 + l_partkey % 26 AS INTEGER)) AS code,
               units_sold * CASE WHEN credit OR d % 79 = 0 THEN -1 ELSE 1 END AS signed_units,
               cents // (units_sold * 1000) AS each,
               (cents // (units_sold * 1000)) // 100 || '.'
                 || lpad(CAST((cents // (units_sold * 1000)) % 100 AS VARCHAR), 2, '0') AS price
        FROM source_lines""",
    "raw_sales": f"""
        SELECT l_orderkey AS seq,
          CAST(l_linenumber AS BIGINT) * 4503599627370496 + CAST('0x' || substr(md5(concat_ws('|',
            l_orderkey, l_partkey, l_suppkey, l_linenumber, cents, units_sold,
            CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
            l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))), 1, 13) AS BIGINT) AS pos,
          {_choose("d", [(101, "''"), (97, "'BAD' || number"), (31, "inv || 'A'"), (29, "'  ' || lower(inv) || ' '")], "inv")} AS InvoiceNo,
          {_choose("d", [(211, "'###'"), (37, "' ' || lower(code) || ' #1'")],
            f"CASE WHEN l_orderkey % 5 = 0 AND d % 4 = 0 THEN (10000 + l_orderkey % 900) || 'B' WHEN l_partkey % 200 < {len(CODES)} THEN ([{_CODES}])[CAST(l_partkey % 200 + 1 AS INTEGER)] ELSE code END")} AS StockCode,
          {_choose("d", [(41, "''"), (43, "upper(part_name) || '., -'"), (47, "'children''s  ' || upper(part_name) || ' t-light'"), (53, "upper(part_name) || ' POSTAGE'"), (59, "upper(part_name) || ' discount 2nd'")], "upper(part_name)")} AS Description,
          {_choose("d", [(71, "'abc'"), (61, "'0'"), (83, "'nan'"), (67, "signed_units || '.7'"), (73, "'1e1'"), (89, "CAST(signed_units * 1000 AS VARCHAR)")], "CAST(signed_units AS VARCHAR)")} AS QuantityText,
          {_choose("d", [(131, "'not a date'"), (137, "'2008-12-31 10:00:00'"), (139, "'2099-01-01'"), (7, _dated("%d-%m-%Y", _HM + " || ':00'")), (11, _dated("%-d/%-m/%Y")), (13, _dated("%-d-%-m-%Y")), (17, _dated("%Y-%m-%d")), (3, _dated("%-d/%-m/%Y", _HM))], _dated("%Y-%m-%d", _HM + " || ':00'"))} AS InvoiceDate,
          {_choose("d", [(113, "'£' || price"), (103, "'0.00'"), (107, "'-' || price"), (109, "each || '.125'"), (193, "each || '.375'"), (127, "'1500.5'")], "price")} AS UnitPrice,
          {_choose("d", [(157, "'.0'"), (149, "'nan'"), (151, "' Unknown '"), (5, "''"), (19, "(custkey + 1) || '.0'"), (23, "CAST(custkey AS VARCHAR)")], "custkey || '.0'")} AS CustomerID,
          CASE WHEN d % 167 = 0 THEN '' ELSE {_choose("l_orderkey", [(17, "'UK'"), (19, "' usa '"), (23, "'united  arab-emirates'")], "upper(nation)")} END AS Country
        FROM source_text""",
    "gated": """
        SELECT *,
          trim(InvoiceNo) <> '' AND trim(StockCode) <> '' AND trim(InvoiceDate) <> ''
          AND regexp_matches(trim(QuantityText), '^(?i)[+-]?((\\d+(\\.\\d*)?|\\.\\d+)(e[+-]?\\d+)?|inf(inity)?|nan)$')
          AND regexp_matches(trim(UnitPrice), '^(?i)[+-]?((\\d+(\\.\\d*)?|\\.\\d+)(e[+-]?\\d+)?|inf(inity)?|nan)$')
          AS is_admitted
        FROM raw_sales""",
    "typed": f"""
        SELECT *,
          upper(trim(InvoiceNo)) AS invoice,
          regexp_replace(upper(trim(StockCode)), '[^\\w\\-\\.]', '', 'g') AS stock_code,
          coalesce(CAST(trunc(TRY_CAST(regexp_replace(QuantityText, '[^\\d\\-\\.]', '', 'g') AS DOUBLE)) AS BIGINT), 0) AS quantity,
          coalesce(CAST(round_even(abs(TRY_CAST(regexp_replace(trim(UnitPrice), '[£$€\\s,]', '', 'g') AS DOUBLE)), 2) AS DECIMAL(10,2)), 0.00) AS unit_price,
          coalesce(
            try_strptime(trim(InvoiceDate), '%Y-%m-%d %H:%M:%S'), try_strptime(trim(InvoiceDate), '%d/%m/%Y %H:%M'),
            try_strptime(trim(InvoiceDate), '%d-%m-%Y %H:%M:%S'), try_strptime(trim(InvoiceDate), '%Y-%m-%d'),
            try_strptime(trim(InvoiceDate), '%d/%m/%Y'), try_strptime(trim(InvoiceDate), '%d-%m-%Y')) AS ts,
          CASE WHEN lower(trim(CustomerID)) IN ('', 'nan', 'none', 'null', 'unknown') THEN ''
               ELSE regexp_replace(trim(CustomerID), '\\.0$', '') END AS own,
          lower(trim(CustomerID)) IN ('', 'nan', 'none', 'null', 'unknown') AS seeks,
          CASE WHEN trim(Description) = '' THEN 'Unknown' ELSE regexp_replace({_title("trim(regexp_replace(Description, '\\s+', ' ', 'g'))")}, '[\\.,\\-\\s]+$', '') END AS description_clean,
          CASE WHEN trim(Country) = '' THEN 'Unknown' WHEN lower(trim(Country)) = 'uk' THEN 'United Kingdom'
               WHEN lower(trim(Country)) = 'usa' THEN 'United States'
               ELSE {_title("trim(Country)")} END AS country_clean
        FROM gated""",
    "checked": f"""
        SELECT *,
          stock_code <> '' AND regexp_matches(invoice, '^[C]?\\d{{5,7}}[A-Z]?$') AND quantity <> 0
          AND coalesce(CAST(ts AS DATE) BETWEEN DATE '2009-01-01' AND DATE '{SALES_AS_OF}', false)
          AND (seeks OR own <> '') AS valid
        FROM typed""",
    "reachable": """
        SELECT *, is_admitted AND valid AND unit_price <> 0 AS ok,
          is_admitted AND valid AND unit_price <> 0 AND max(
            CASE WHEN is_admitted AND valid AND unit_price <> 0 AND own <> '' THEN 1 ELSE 0 END)
            OVER (PARTITION BY invoice ORDER BY pos ROWS UNBOUNDED PRECEDING) = 1 AS reach
        FROM checked""",
    "settled": """
        SELECT *, reach AND row_number() OVER (PARTITION BY invoice, stock_code, reach ORDER BY pos) = 1 AS kept
        FROM reachable""",
    "filled": """
        SELECT *, last_value(CASE WHEN kept AND own <> '' THEN own END IGNORE NULLS)
            OVER (PARTITION BY invoice ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fill
        FROM settled""",
}

VIEWS["judged"] = """
        SELECT seq, pos, InvoiceNo, StockCode, QuantityText, InvoiceDate, UnitPrice, CustomerID,
          invoice, stock_code, quantity, unit_price, ts, is_admitted,
          description_clean AS description, country_clean AS country,
          CASE WHEN own <> '' THEN own WHEN seeks AND invoice <> '' THEN fill END AS customer_id,
          CASE WHEN NOT is_admitted THEN 'ingest_invalid'
               WHEN trim(CustomerID) = '' AND fill IS NULL THEN 'missing_required_field'
               WHEN NOT valid OR (own = '' AND fill IS NULL) THEN 'validation_failed'
               WHEN unit_price = 0 THEN 'unit_price_zero_quarantine'
               WHEN NOT kept THEN 'duplicate' END AS reject_reason
        FROM filled"""
VIEWS["accepted"] = "SELECT * FROM judged WHERE reject_reason IS NULL"

# Codes with a category of their own; below, types with their sign.
_SPECIAL = {
    "AMAZONFEE": ("Fees", "Marketplace Fee", False),
    "BANKCHARGES": ("Fees", "Bank Charge", False),
    "POST": ("Shipping", "Postage", False),
    "DOT": ("Adjustment", "Rounding", False),
    "D": ("Discount", "Manual Discount", False),
    "M": ("Adjustment", "Manual", False),
    "S": ("Services", "Service Charge", False),
    "CRUK": ("Charity", "Donation", False),
    "PADS": ("Stationery", "Pads", False),
    "C2": ("Shipping", "Carrier Surcharge", False),
}
_ROWS = ", ".join(f"('{k}', '{c}', '{s}', {str(g).lower()})" for k, (c, s, g) in _SPECIAL.items())
VIEWS["special_codes"] = f"SELECT * FROM (VALUES {_ROWS}) t(code, category, subcategory, is_gift)"
VIEWS["tagged"] = """
        SELECT a.*,
          CASE WHEN s.code IS NOT NULL THEN s.category
               WHEN stock_code LIKE 'GIFT\\_%' ESCAPE '\\' THEN 'Gift Voucher'
               WHEN stock_code LIKE 'DCGS%' THEN 'Gift Sets'
               WHEN upper(description) LIKE '%POSTAGE%' OR upper(description) LIKE '%SHIPPING%' THEN 'Shipping'
               WHEN upper(description) LIKE '%DISCOUNT%' THEN 'Discount'
               ELSE 'Merchandise' END AS category,
          CASE WHEN s.code IS NOT NULL THEN s.subcategory
               WHEN regexp_matches(stock_code, 'GIFT_[A-Z0-9]+_\\d+') THEN 'Voucher £' || regexp_extract(stock_code, 'GIFT_[A-Z0-9]+_(\\d+)', 1)
               WHEN stock_code LIKE 'GIFT\\_%' ESCAPE '\\' THEN 'Voucher'
               WHEN stock_code = 'DCGSSBOY' THEN 'Boy' WHEN stock_code = 'DCGSSGIRL' THEN 'Girl'
               WHEN stock_code LIKE 'DCGS%' THEN 'DCGS'
               WHEN upper(description) LIKE '%POSTAGE%' OR upper(description) LIKE '%SHIPPING%' THEN 'Postage'
               WHEN upper(description) LIKE '%DISCOUNT%' THEN 'Promotion'
               ELSE 'General' END AS subcategory,
          CASE WHEN s.code IS NOT NULL THEN s.is_gift
               ELSE stock_code LIKE 'GIFT\\_%' ESCAPE '\\' OR stock_code LIKE 'DCGS%' END AS is_gift,
          starts_with(invoice, 'C') AS credit
        FROM accepted a LEFT JOIN special_codes s ON a.stock_code = s.code"""
VIEWS["lines"] = """
        SELECT seq, pos, invoice,
          CASE WHEN regexp_matches(invoice, '^C?\\d+$') THEN CAST(regexp_replace(invoice, '^C', '') AS BIGINT) ELSE 0 END AS invoice_no,
          CASE category
            WHEN 'Fees' THEN CASE WHEN credit THEN 'FEE_REVERSAL' ELSE 'FEE' END
            WHEN 'Shipping' THEN CASE WHEN credit THEN 'SHIPPING_REFUND' ELSE 'SHIPPING_CHARGE' END
            WHEN 'Discount' THEN CASE WHEN credit THEN 'DISCOUNT_REVERSAL' ELSE 'DISCOUNT' END
            WHEN 'Charity' THEN 'DONATION'
            WHEN 'Adjustment' THEN CASE WHEN quantity < 0 THEN 'ADJUSTMENT_OUT' ELSE 'ADJUSTMENT_IN' END
            WHEN 'Services' THEN CASE WHEN quantity < 0 THEN 'ADJUSTMENT_OUT' ELSE 'ADJUSTMENT_IN' END
            WHEN 'Gift Voucher' THEN CASE WHEN credit OR quantity < 0 THEN 'VOUCHER_REDEMPTION' ELSE 'VOUCHER_SALE' END
            ELSE CASE WHEN credit THEN 'RETURN' WHEN quantity < 0 THEN 'ADJUSTMENT_OUT' ELSE 'SALE' END
          END AS transaction_type,
          abs(quantity) AS quantity, unit_price,
          CAST(abs(quantity) * unit_price AS DECIMAL(15,2)) AS line_total,
          ts AS transaction_datetime, CAST(ts AS DATE) AS transaction_date,
          customer_id, stock_code, description, country, category, subcategory, is_gift
        FROM tagged"""
VIEWS["effects"] = """
        SELECT * FROM (VALUES ('SALE', 1), ('RETURN', -1), ('ADJUSTMENT_IN', 1), ('ADJUSTMENT_OUT', -1),
          ('DISCOUNT', -1), ('DISCOUNT_REVERSAL', 1), ('FEE', -1), ('FEE_REVERSAL', 1),
          ('SHIPPING_CHARGE', 1), ('SHIPPING_REFUND', -1), ('VOUCHER_SALE', 0),
          ('VOUCHER_REDEMPTION', -1), ('DONATION', -1), ('SERVICE', 1)) t(transaction_type, effect_sign)"""
VIEWS["products"] = """
        SELECT stock_code,
          first(description ORDER BY length(description) DESC, seq, pos) AS description,
          last(category ORDER BY seq, pos) AS category, last(subcategory ORDER BY seq, pos) AS subcategory,
          bool_or(is_gift) AS is_gift,
          row_number() OVER (ORDER BY substr(md5(stock_code), 1, 3), stock_code) AS product_key
        FROM lines GROUP BY stock_code"""
VIEWS["customers"] = """
        SELECT customer_id, first(country ORDER BY seq, pos) AS country,
          row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id) AS customer_key
        FROM lines GROUP BY customer_id"""
VIEWS["fact"] = f"""
        SELECT CAST(strftime(transaction_date, '%Y%m%d') AS BIGINT) AS date_key, customer_key, product_key,
          invoice_no, transaction_type, quantity, unit_price, line_total, transaction_datetime,
          TIMESTAMP '{LOADED_AT}' AS created_at, year(transaction_datetime) AS txn_year,
          l.stock_code, l.customer_id, l.invoice, l.seq, l.pos
        FROM lines l JOIN products p ON l.stock_code = p.stock_code
        JOIN customers c ON l.customer_id = c.customer_id"""
VIEWS["history"] = """
        SELECT CAST(event_id AS VARCHAR) AS metric_id, event_id,
          CASE user_id % 3 WHEN 0 THEN 'dim_customer' WHEN 1 THEN 'dim_product' ELSE 'fact_sales' END AS table_name,
          event_type AS metric_name, CAST(least(value, 100.0) AS DECIMAL(15,4)) AS metric_value, ts AS measured_at
        FROM events"""


def query(final: str, extra: dict[str, str] | None = None) -> str:
    """The statement with every view it needs in front, in order of need."""
    views = {**VIEWS, **(extra or {})}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in views:
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                visit(views[name])
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final
    steps = ",\n".join(f"{name} AS MATERIALIZED ({views[name]})" for name in ordered)
    return f"WITH {steps}\n{final}"
