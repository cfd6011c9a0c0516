"""Landed pages of all source kinds, made up for the tests."""

import json
from datetime import datetime

LANDED = datetime(2024, 5, 1, 12, 0, 0)
VAT_A, VAT_B = "23456787", "10000009"  # both with a right check digit


def page(source, region, number, body):
    return (source, region, number, body if isinstance(body, str) else json.dumps(body, ensure_ascii=False), LANDED)


def results(*records):
    return {"page": 1, "results": list(records)}


DIRECTORY = [
    page("directory", "budapest", 1, results(
        {"id": 7, "name": " Kék Klíma Kft. ", "email": "INFO@kekklima.hu", "phone": "06 30 111 2233",
         "website": "www.kekklima.hu", "address": "1132 Budapest, Váci út 4", "vat": "23456787-2-41",
         "activity": "klíma szerelés"},
        {"id": 8, "name": "  ", "email": "nobody@x.hu"},
        {"name": "Fényes Iroda Bt.", "website": "fenyesiroda.hu", "activity": "takarítás"})),
    page("directory", "budapest", 2, results(
        {"id": "9", "name": "Tiltott Kft.", "email": "a@tiltott.hu", "activity": "őrzés"})),
    page("directory", "pest", 1, results(
        {"id": 10, "name": "Gödöllői Szerver Kft.", "address": "2100 Gödöllő", "activity": "szerver"})),
]

REGISTRY = [
    page("ebeszamolo", "budapest", 1, results(
        {"id": 1, "companyName": "KÉK KLÍMA KFT", "taxNumber": "HU23456787", "registrationNumber": "02-09-345678",
         "seat": "1132 Budapest", "teaorCode": "43.22", "teaorText": "gépészet, hosszabb leírással együtt"},
        {"id": 2, "companyName": "Őr-Zés Zrt.", "registrationNumber": "01-10-222222", "teaorCode": "8010"})),
    page("mkik", "budapest", 1, results(
        {"id": 3, "companyName": "Őrzés Zrt", "registrationNumber": "01 10 222222", "phone": "+36 1 222 3333"})),
    page("opencorporates", "budapest", 1, results(
        {"companyName": "Fényes Iroda", "website": "https://www.fenyesiroda.hu/", "email": "info@fenyesiroda.hu"})),
]

AWARDS = [page("kozbeszerzes", "budapest", 1, results(
    {"id": "K1", "supplierName": "Kék Klíma Kft.", "supplierVat": "23456787", "cpvCodes": ["90919200-4"],
     "title": "irodaház"}))]

SOLE_TRADERS = [page("evny", "budapest", 1, results(
    {"id": 1, "name": "Nagy Péter e.v.", "registrationNumber": "12345678", "teaorCode": "8121",
     "email": "nagy.peter@pelda.hu"}))]

POI = [page("overpass", "budapest", 1, {"elements": [
    {"type": "node", "id": 11, "tags": {"name": "Kék Klíma", "operator": "Kék Csoport", "office": "company",
                                        "ref:vatin": "HU23456787", "addr:city": "Budapest",
                                        "addr:street": "Váci út", "contact:phone": "06 1 222 3344"}},
    {"type": "way", "id": 12, "tags": {"operator": "Magányos Bolt", "shop": "it", "email": "bolt@pelda.hu",
                                       "addr:postcode": "1051"}},
    {"type": "node", "id": 13, "tags": {"shop": "yes"}},
    {"type": "node", "id": 14}]})]

LISTING = [
    page("htmldir", "budapest", 1, """<ul>
      <li class="big biz" data-id="a1"><h3 class="name">Tűz &amp; Társa Kft.</h3><span class="cat">tűzvédelem</span>
        <a class="email" href="mailto:iroda@tuztarsa.hu">írjon</a><b class="phone">06 20 333 4444</b>
        <a class="web" href="https://tuztarsa.hu">web</a><i class="addr">1111 Budapest</i></li>
      <div class="biz"><p class="name"></p></div>
      <article class="other biz x"><p class="name">Második&#x20;Kft.</p><em class="email">b@masodik.hu</em></article>
      <li class="bizarre"><p class="name">No Card</p></li></ul>"""),
]

ALL = DIRECTORY + REGISTRY + AWARDS + SOLE_TRADERS + POI + LISTING
