"""A small garden shop with deliberate faults.

Three totals differ from their items, one item belongs to no order, one order has an unknown customer,
one order has no items, and two customers share an address.
"""

import datetime as dt
from decimal import Decimal

from sievework.layouts import shop

CUSTOMERS = """
11,Ilse Brandt,ilse@mail.test,AT,2022-05-02
12,Tomas Novak,tomas@mail.test,CZ,2022-06-11
13,Maria Rossi,maria@mail.test,IT,2022-07-19
14,Petr Svoboda,petr@mail.test,CZ,2022-09-30
15,Lena Gruber,ilse@mail.test,AT,2023-01-08
16,Paolo Bianchi,paolo@mail.test,IT,2023-02-20
"""
PRODUCTS = """
501,Watering Can,Garden,18.50,true
502,Hand Rake,Garden,12.00,true
503,Seed Tray,Nursery,4.25,true
504,Clay Pot,Nursery,7.75,false
"""
ORDERS = """
7001,11,2023-05-03 08:00:00,completed,49.00
7002,12,2023-05-20 19:45:00,completed,17.00
7003,13,2023-06-01 10:10:00,completed,30.00
7004,14,2023-06-15 12:00:00,cancelled,24.00
7005,12,2023-06-28 15:30:00,completed,18.50
7006,77,2023-07-04 09:00:00,completed,12.00
7007,11,2023-07-09 21:15:00,pending,8.50
7008,16,2023-07-21 07:05:00,completed,60.00
7009,13,2023-07-30 16:00:00,completed,31.00
"""
ORDER_ITEMS = """
1,7001,501,2,18.50
2,7001,502,1,12.00
3,7002,503,4,4.25
4,7003,504,4,7.75
5,7004,502,2,12.00
6,7005,501,1,18.50
7,7006,502,1,12.00
8,7007,503,2,4.25
9,8888,503,1,4.25
10,7009,501,1,18.50
11,7009,502,1,12.00
"""
TEXT = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "order_items": ORDER_ITEMS}
READ = {
    "int": int,
    "string": str,
    "date": dt.date.fromisoformat,
    "timestamp": dt.datetime.fromisoformat,
    "boolean": lambda v: v == "true",
}


def csv(name: str) -> str:
    contract = next(c for c in shop.SHOP if c.name == name)
    return ",".join(contract.names) + "\n" + TEXT[name].strip() + "\n"


def frame(spark, name: str):
    contract = next(c for c in shop.SHOP if c.name == name)
    kinds = [READ.get(f.dataType.simpleString(), Decimal) for f in contract.schema]
    rows = [tuple(k(v) for k, v in zip(kinds, line.split(","))) for line in TEXT[name].strip().splitlines()]
    return spark.createDataFrame(rows, contract.schema)
