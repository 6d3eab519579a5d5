"""DuckDB building blocks: the flat records and the staging tables as CTEs."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"

_LINE_COLUMNS = """
    CAST(l_partkey AS VARCHAR) AS Product_Card_Id,
    CAST(p_size AS VARCHAR) AS Product_Category_Id,
    p_type AS Category_Name,
    p_brand || ' ' || p_name AS Product_Description,
    'https://example.com/product/' || CAST(l_partkey AS VARCHAR) AS Product_Image,
    p_name AS Product_Name,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS Product_Price,
    CAST(p_size % 2 AS VARCHAR) AS Product_Status,
    CAST(o_orderkey AS VARCHAR) AS Order_Id,
    strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS Order_Date,
    CAST(o_custkey AS VARCHAR) AS Order_Customer_Id,
    CAST(l_linenumber AS VARCHAR) AS Order_Item_Id,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(3,2)) AS VARCHAR)
        AS Order_Item_Discount,
    CAST(CAST(l_discount AS DECIMAL(3,2)) AS VARCHAR) AS Order_Item_Discount_Rate,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS Order_Item_Product_Price,
    CAST(CAST(l_tax AS DECIMAL(3,2)) AS VARCHAR) AS Order_Item_Profit_Ratio,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS Order_Item_Quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2))
        * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS VARCHAR) AS Sales_per_customer,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS Sales,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2))
        * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS VARCHAR) AS Order_Item_Total,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(3,2)) AS VARCHAR)
        AS Order_Profit_Per_Order,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'PROCESSING' END
        AS Order_Status,
    CAST(n.n_nationkey AS VARCHAR) AS Department_Id,
    strftime(l_shipdate, '%-m/%-d/%Y %-H:%M') AS Shipping_date,
    CAST(date_diff('day', o_orderdate, l_shipdate) AS VARCHAR) AS Days_for_shipping_real,
    substr(o_orderpriority, 1, 1) AS Days_for_shipping_scheduled,
    o_orderpriority AS Shipping_Mode,
    CASE l_returnflag WHEN 'A' THEN 'Advance shipping' WHEN 'R' THEN 'Late delivery'
        ELSE 'Shipping on time' END AS Delivery_Status,
    n.n_name AS Department_Name,
    r.r_name AS Market,
    CAST(o_orderkey AS VARCHAR) AS "key",
    CAST(l_partkey * 100 + l_linenumber AS VARCHAR) AS "offset",
    CAST(l_suppkey % 16 AS VARCHAR) AS "partition",
    CAST(epoch_ms(o_orderdate) AS VARCHAR) AS "time",
    'supply-chain-orders' AS topic"""

_CUSTOMER_COLUMNS = """
    CAST(c_custkey AS VARCHAR) AS Customer_Id,
    lower(replace(c_name, '#', '.')) || '@example.com' AS Customer_Email,
    split_part(c_name, '#', 1) AS Customer_Fname,
    split_part(c_name, '#', 2) AS Customer_Lname,
    c_mktsegment AS Customer_Segment,
    'City of ' || h.n_name AS Customer_City,
    h.n_name AS Customer_Country,
    'State of ' || h.n_name AS Customer_State,
    CAST(c_custkey AS VARCHAR) || ' Main Street' AS Customer_Street,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS Customer_Zipcode,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS Order_Zipcode,
    'City of ' || h.n_name AS Order_City,
    'State of ' || h.n_name AS Order_State,
    hr.r_name AS Order_Region,
    h.n_name AS Order_Country,
    CAST(CAST(c_nationkey AS DECIMAL(6,2)) AS VARCHAR) AS Latitude,
    CAST(CAST(-c_nationkey AS DECIMAL(6,2)) AS VARCHAR) AS Longitude"""

_LINE_JOIN = """
    lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation n ON s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""

_CUSTOMER_JOIN = """
    JOIN customer ON o_custkey = c_custkey
    JOIN nation h ON c_nationkey = h.n_nationkey
    JOIN region hr ON h.n_regionkey = hr.r_regionkey"""

_FLAT = f"SELECT {_LINE_COLUMNS}\nFROM {_LINE_JOIN}"
_FLAT_CUSTOMERS = f"SELECT {_LINE_COLUMNS},{_CUSTOMER_COLUMNS}\nFROM {_LINE_JOIN}{_CUSTOMER_JOIN}"


def _first_rows(keys: str, order: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM flat) WHERE rn = 1)"
    )


FIRST_ROWS = {
    "customer": _first_rows("Customer_Id", "Customer_Email"),
    "product": _first_rows("Product_Card_Id", "Product_Name"),
    "location": _first_rows("Order_Zipcode", "Order_City"),
    "order": _first_rows(
        "Order_Id", "Order_Item_Id, Product_Card_Id, Department_Id, Shipping_date, Sales"
    ),
    "shipping": _first_rows(
        "Shipping_date, Shipping_Mode", "Order_Id, Order_Item_Id, Product_Card_Id, Department_Id, Sales"
    ),
    "department": _first_rows("Department_Id", "Department_Name"),
    "metadata": _first_rows('"key"', 'topic, "partition", "offset"'),
}

STAGED = {
    "customer": f"""SELECT CAST(Customer_Id AS BIGINT) AS customer_id, Customer_Email AS customer_email,
        Customer_Fname AS customer_fname, Customer_Lname AS customer_lname,
        Customer_Segment AS customer_segment, Customer_City AS customer_city,
        Customer_Country AS customer_country, Customer_State AS customer_state,
        Customer_Street AS customer_street, Customer_Zipcode AS customer_zipcode
        FROM {FIRST_ROWS['customer']}""",
    "product": f"""SELECT CAST(Product_Card_Id AS BIGINT) AS product_card_id,
        CAST(Product_Category_Id AS BIGINT) AS product_category_id, Category_Name AS category_name,
        Product_Description AS product_description, Product_Image AS product_image,
        Product_Name AS product_name, CAST(Product_Price AS DOUBLE) AS product_price,
        Product_Status AS product_status
        FROM {FIRST_ROWS['product']}""",
    "location": f"""SELECT Order_Zipcode AS order_zipcode, Order_City AS order_city,
        Order_State AS order_state, Order_Region AS order_region, Order_Country AS order_country,
        CAST(Latitude AS DOUBLE) AS latitude, CAST(Longitude AS DOUBLE) AS longitude
        FROM {FIRST_ROWS['location']}""",
    "order": f"""SELECT CAST(Order_Id AS BIGINT) AS order_id, Order_Date AS order_date,
        CAST(Order_Customer_Id AS BIGINT) AS order_customer_id,
        CAST(Order_Item_Id AS BIGINT) AS order_item_id,
        CAST(Product_Card_Id AS BIGINT) AS product_card_id,
        CAST(Order_Item_Discount AS DOUBLE) AS order_item_discount,
        CAST(Order_Item_Discount_Rate AS DOUBLE) AS order_item_discount_rate,
        CAST(Order_Item_Product_Price AS DOUBLE) AS order_item_product_price,
        CAST(Order_Item_Profit_Ratio AS DOUBLE) AS order_item_profit_ratio,
        CAST(Order_Item_Quantity AS BIGINT) AS order_item_quantity,
        CAST(Sales_per_customer AS DOUBLE) AS sales_per_customer, CAST(Sales AS DOUBLE) AS sales,
        CAST(Order_Item_Total AS DOUBLE) AS order_item_total,
        CAST(Order_Profit_Per_Order AS DOUBLE) AS order_profit_per_order,
        Order_Status AS order_status, CAST(Department_Id AS BIGINT) AS department_id
        FROM {FIRST_ROWS['order']}""",
    "shipping": f"""SELECT Shipping_date AS shipping_date,
        CAST(Days_for_shipping_real AS BIGINT) AS days_for_shipping_real,
        CAST(Days_for_shipping_scheduled AS BIGINT) AS days_for_shipping_scheduled,
        Shipping_Mode AS shipping_mode, Delivery_Status AS delivery_status
        FROM {FIRST_ROWS['shipping']}""",
    "department": f"""SELECT CAST(Department_Id AS BIGINT) AS department_id,
        Department_Name AS department_name, Market AS market
        FROM {FIRST_ROWS['department']}""",
    "metadata": f"""SELECT "key" AS metadata_key, CAST("offset" AS BIGINT) AS metadata_offset,
        CAST("partition" AS BIGINT) AS metadata_partition, CAST("time" AS BIGINT) AS metadata_time,
        topic AS metadata_topic
        FROM {FIRST_ROWS['metadata']}""",
}

MONTHS = """SELECT * FROM (VALUES (1, 'January'), (2, 'February'), (3, 'March'), (4, 'April'), (5, 'May'),
    (6, 'June'), (7, 'July'), (8, 'August'), (9, 'September'), (10, 'October'), (11, 'November'),
    (12, 'December')) AS calendar(month_num, month_name)"""


def over_flat(body: str, customers: bool = False, **ctes: str) -> str:
    """``body`` with the flat records as ``flat`` and further CTEs by name."""
    parts = {"flat": _FLAT_CUSTOMERS if customers else _FLAT, **ctes}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + body


def over_staged(body: str, *names: str, **ctes: str) -> str:
    """``body`` with staging tables as ``stg_<name>``, the months, and further CTEs."""
    tables = {f"stg_{name}": STAGED[name] for name in names}
    customers = any(name in ("customer", "location") for name in names)
    return over_flat(body, customers, **tables, months=MONTHS, **ctes)


def parsed(date_text: str) -> str:
    return f"strptime({date_text}, '%m/%d/%Y %H:%M')"


def year_of(date_text: str) -> str:
    return f"CAST(year({parsed(date_text)}) AS BIGINT)"


def month_of(date_text: str) -> str:
    return f"CAST(month({parsed(date_text)}) AS BIGINT)"


def money(value: str) -> str:
    """Exact amount of a staged double."""
    return f"CAST({value} AS DECIMAL(18,4))"


def money_sum(value: str) -> str:
    return f"CAST(SUM({money(value)}) AS DOUBLE)"


def money_avg(value: str) -> str:
    return f"(CAST(SUM({money(value)}) AS DOUBLE) / COUNT({value}))"


def rounded_ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    """Ratio of two whole numbers rounded half away from zero, in integer arithmetic.

    DuckDB rounds a double by scaling it, which can miss a tie either way.
    """
    top, bottom, unit = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10**digits
    half_up = f"((2 * {unit} * abs({top}) + abs({bottom})) // NULLIF(2 * abs({bottom}), 0))"
    return f"(CAST(sign({top}) * sign({bottom}) * {half_up} AS DOUBLE) / {unit})"


def rounded_ratio_even(numerator: str, denominator: str, digits: int = 2) -> str:
    """Like ``rounded_ratio`` for non-negative numbers, ties going to the even digit."""
    top, bottom = f"(CAST({numerator} AS HUGEINT) * {10**digits})", f"CAST({denominator} AS HUGEINT)"
    whole, rest = f"({top} // {bottom})", f"(2 * ({top} % {bottom}))"
    up = f"CASE WHEN {rest} > {bottom} OR ({rest} = {bottom} AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(CAST({whole} + {up} AS DOUBLE) / {10**digits})"


def money_units(value: str) -> str:
    """Exact sum of a staged amount in ten-thousandths."""
    return f"CAST(SUM({money(value)}) * 10000 AS HUGEINT)"


# Range of an age in whole days, from a column named age.
AGE_RANGE = """CASE WHEN age <= 30 THEN '0-30 days' WHEN age <= 60 THEN '31-60 days'
    WHEN age <= 90 THEN '61-90 days' ELSE 'Over 90 days' END"""
