"""Small source files in the layouts of the nine entities."""

from __future__ import annotations

import csv
from pathlib import Path

from tiffinmart import entities


def put(folder: Path, name: str, entity: str, *records: dict) -> Path:
    """A CSV file of the entity; columns a record does not name get a neutral value."""
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    columns = entities.get(entity).source_columns
    with path.open("w", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(columns)
        for r in records:
            out.writerow([r.get(c, DEFAULTS.get(c, "-")) for c in columns])
    return path


DEFAULTS = {
    "createddate": "2024-01-01 00:00:00",
    "modifieddate": "2024-01-01 00:00:00",
    "state": "Goa",
    "city": "Panaji",
    "zipcode": "403001",
    "activeflag": "Yes",
    "pricing_for_2": "300.00",
    "latitude": "15.5",
    "longitude": "73.8",
    "dob": "1990-01-01",
    "anniversary": "2015-01-01",
    "availability": "true",
    "rating": "4.5",
    "quantity": "1",
    "estimatedtime": "30 minutes",
}


def location(i, **kw):
    return {"locationid": i, **kw}


def restaurant(i, **kw):
    return {"restaurantid": i, "name": f"R{i}", "locationid": "1", **kw}


def customer(i, **kw):
    return {"customerid": i, "name": f"C{i}", **kw}


def address(i, customer_id, **kw):
    return {"addressid": i, "customerid": customer_id, "createddate": "2024-01-01T00:00:00", **kw}


def menu(i, price, **kw):
    return {"menuid": i, "restaurantid": "1", "itemname": f"Dish {i}", "price": price, **kw}


def agent(i, **kw):
    return {"deliveryagentid": i, "name": f"A{i}", "locationid": "1", **kw}


def order(i, customer_id, day, **kw):
    return {
        "orderid": i, "customerid": customer_id, "restaurantid": "1", "orderdate": f"{day} 12:00:00",
        "totalamount": "100.00", "status": "NEW", "paymentmethod": "card", **kw,
    }


def delivery(i, order_id, address_id, status="Delivered", **kw):
    return {
        "deliveryid": i, "orderid": order_id, "deliveryagentid": "1", "deliverystatus": status,
        "addressid": address_id, "deliverydate": "2024-01-05 13:00:00", **kw,
    }


def item(i, order_id, menu_id, subtotal, **kw):
    return {"orderitemid": i, "orderid": order_id, "menuid": menu_id, "price": subtotal, "subtotal": subtotal, **kw}
