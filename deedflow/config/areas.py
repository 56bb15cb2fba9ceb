"""The reviewed areas, their scopes and their aliases.

Fixed values, in their usual order.  Every area is an alias of its own; the other aliases are spelling variants.
"""

from __future__ import annotations

INFERENCE_AREAS = (
    "Sandymount", "Ballsbridge", "Ranelagh", "Rathmines", "Rathgar", "Terenure", "Donnybrook", "Milltown", "Dartry", "Clonskeagh", "Windy Arbour",
    "Churchtown", "Dundrum", "Goatstown", "Foxrock", "Seapoint", "Blackrock", "Booterstown", "Merrion", "Mount Merrion", "Kilmacud", "Stillorgan",
    "Ardilea", "Monkstown",
)
TRAINING_AREAS = (
    "Harolds Cross", "Kimmage", "Templeogue", "Rathfarnham", "Knocklyon", "Butterfield", "Edmondstown", "Ballyboden", "Scholarstown", "Ballinteer",
    "Balally", "Sandyford", "Kilgobbin", "Carrickmines", "Kilternan", "Deansgrange", "Cabinteely", "Loughlinstown", "Shankill", "Ballybrack",
    "Killiney", "Kilbogget", "Glenageary", "Thomastown", "Dalkey", "Woodpark", "Sandycove", "Dún Laoghaire",
)
VARIANTS = {
    "Windy Arbour": ("Windy-Arbour",),
    "Mount Merrion": ("Mount-Merrion",),
    "Harolds Cross": ("Harold's Cross", "Harold’s Cross"),
    "Dún Laoghaire": ("Dun Laoghaire", "Dun-Laoghaire"),
}
PRIORITIES = {"Merrion": 80, "Mount Merrion": 10}
USUAL_PRIORITY = 50
NON_UNIQUE_AREAS = ("Blackrock", "Milltown", "Churchtown", "Monkstown", "Shankill")
BROAD_REFERENCES = ("DUBLIN", "DUBLIN 4", "DUBLIN 6", "DUBLIN 6W", "DUBLIN 14", "DUBLIN 16", "SOUTH DUBLIN", "DUN LAOGHAIRE RATHDOWN", "DÚN LAOGHAIRE RATHDOWN")
CAPITAL = "DUBLIN"
#: What may follow the capital in a reference to no more than a postal district.
DISTRICT = "^[0-9]{1,2}[A-Z]?$"
#: An area that is not meant where the address names the authority of the same name.
BLOCKED = ("Dún Laoghaire", ("DUN LAOGHAIRE RATHDOWN", "DUN LAOGHAIRE - RATHDOWN", "DUN LAOGHAIRERATHDOWN"))

SCOPE_BY_AREA = {a: "inference" for a in INFERENCE_AREAS} | {a: "training_only" for a in TRAINING_AREAS}


def alias_rows() -> list[dict[str, str]]:
    """The alias table as its rows would be read from a file."""
    return [
        {"canonical_area": area, "alias": alias, "scope": scope, "match_type": "controlled_phrase", "match_priority": str(PRIORITIES.get(area, USUAL_PRIORITY)), "notes": ""}
        for area, scope in SCOPE_BY_AREA.items()
        for alias in (area, *VARIANTS.get(area, ()))
    ]
