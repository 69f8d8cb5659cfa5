"""Invented delimited files under the payments contract, most lines good.

Expected verdict, read together with as_of 2026-04-01: 18 rows, 8 valid,
10 invalid, 12 violations; valid per file 2 / 3 / 3.
"""

import os

HEADER = "record_id,event_ts,business_date,source_system,currency,amount,status,merchant_category,country_code"

FILES = {
    "payments_2026-03-01.csv": [
        "A1,2026-03-01 06:12:44,2026-03-01,WIRE_HUB,GBP,812.40,NEW,BOOKS,IE",
        "A2,2026-03-01 21:40:02,2026-03-02,WALLET_X,EUR,3.15,REVERSED,GAMES,PT",
        "A3,2026-03-01 13:05:30,2026-03-01,CARD_PROC,USD,64.99,FAILED,TOYS,CA",
    ],
    "payments_2026-03-02.csv": [
        "B1|2026-03-02 03:00:01|2026-03-02|ACH_GATEWAY|GBP|71.25|NEW|ART|NO",
        "B2;2026-03-02 03:00:02;2026-03-02;WALLET_X;EUR;18.80;FAILED;MUSIC;PL",
        # a quote that is never closed swallows the rest of the line
        'B3,2026-03-02 03:00:03,2026-03-02,WIRE_HUB,USD,90.10,NEW,"GARDEN,MX',
        # ends after the amount
        "B4,2026-03-02 03:00:04,2026-03-02,ACH_GATEWAY,EUR,44.00",
        # two fields too many
        "B5,2026-03-02 03:00:05,2026-03-02,CARD_PROC,GBP,5.05,REVERSED,PETS,CH,7,8",
        # the same id as in the file before
        "A3,2026-03-02 03:00:06,2026-03-02,ACH_GATEWAY,EUR,27.30,NEW,PETS,AT",
        # no currency
        "B6,2026-03-02 03:00:07,2026-03-02,WALLET_X,,33.33,FAILED,ART,BE",
        # one id with and without a space; the first also has a month 14
        "B7 ,2026-03-02 03:00:08,2026-14-02,WIRE_HUB,USD,12.00,NEW,MUSIC,SE",
        "B7,2026-03-02 03:00:09,2026-03-02,WIRE_HUB,USD,12.00,NEW,MUSIC,SE",
        # an amount in words
        "B8,2026-03-02 03:00:10,2026-03-02,CARD_PROC,GBP,twelve,NEW,TOYS,FI",
        "  \t ",
    ],
    "payments_2026-03-03.csv": [
        "C1,2026-03-03 17:20:00,2026-03-03,ACH_GATEWAY,USD,402.00,SETTLED,TRAVEL,JP",
        "C2,2026-03-04 00:10:00,2026-03-04,WIRE_HUB,GBP,58.60,NEW,BOOKS,NZ",
        # thirteen days apart
        "C3,2026-03-16 11:11:11,2026-03-03,WALLET_X,EUR,6.10,REVERSED,GAMES,GR",
        # a country code with a digit
        "C4,2026-03-03 18:45:00,2026-03-03,CARD_PROC,EUR,9.99,FAILED,ART,X1",
        "C5,2026-03-03 19:30:00,2026-03-03,ACH_GATEWAY,GBP,120.00,NEW,HOME;GARDEN,DK",
    ],
}

EXPECTED_VIOLATIONS = {
    "A1": 0, "A2": 0, "A3": 1, "B1": 0, "B2": 0, "B3": 1, "B4": 2, "B5": 0, "B6": 1, "B7 ": 2, "B7": 1,
    "B8": 1, "C1": 0, "C2": 0, "C3": 1, "C4": 1, "C5": 0,
}


def write(folder: str, files=None, header: str | None = HEADER) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, lines in (files or FILES).items():
        with open(os.path.join(folder, name), "w", newline="") as fh:
            fh.write("\r\n".join(([] if header is None else [header]) + lines))
    return folder
