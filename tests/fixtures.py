"""Hand-worked fixture rows (FIXTURES.md §3) and helpers to write raw files."""

import os

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
D = "2010-12-01 08:26:00"


def line(inv="536365", stock="S1", desc="WIDGET", qty="6", date=D, price="2.5", cust="17850", country="UK"):
    return ",".join([inv, stock, desc, qty, date, price, cust, country])


# (record_number, line, expected reason)
ROWS = [
    (2, line(), ""),
    (3, line(inv=""), "required_invoice_no"),
    (4, line(inv=" "), "required_invoice_no"),
    (5, line(inv="536366", stock=" "), "required_stock_code"),
    (6, line(inv="536367", qty="0"), "valid_quantity"),
    (7, line(inv="536368", qty="abc"), "valid_quantity"),
    (8, line(inv="C536369", qty="-3"), ""),
    (9, line(inv="C536370", qty="0"), ""),
    (10, line(inv="c536371", qty="-3"), "valid_quantity"),
    (11, line(inv="c536372", qty="3"), ""),
    (12, line(inv="C536373", qty=""), "valid_quantity"),
    (13, line(inv="536374", qty="1", price="0"), ""),
    (14, line(inv="536375", qty="1", price="-0.01"), "positive_unit_price"),
    (15, line(inv="536376", qty="1", date="not a date"), "valid_invoice_date"),
    (16, line(inv="536377", qty="1", country="NA"), "required_country"),
    (
        17,
        line(inv="", stock="", qty="-1", date="", price="", country=""),
        "required_invoice_no;required_stock_code;valid_quantity;positive_unit_price;valid_invoice_date;required_country",
    ),
    (18, line(), ""),
    (19, line(inv="536378", qty="2.5"), ""),
]


def write_file(folder, name, text, binary=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    mode = "wb" if binary is not None else "w"
    with open(path, mode) as fh:
        fh.write(binary if binary is not None else text)
    return path


def fixture_text(header=HEADER):
    return header + "\n" + "\n".join(r[1] for r in ROWS) + "\n"
