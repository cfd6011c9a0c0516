"""Rule tables: categories, regions and code prefixes.

All of them may be user data: pass your own lists, or read them from a table with
:func:`load_rules`. A rule set becomes part of the expressions, so its size is checked
when it loads; :class:`firmfold.operators.rule_tables.RuleTables` joins rules of any number.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from firmfold.functions.text import fold_str

MAX_RULE_ROWS = 20_000


@dataclass(frozen=True)
class Category:
    """A category, with stems that match anywhere and words that stand alone."""

    id: str
    name: str
    stems: tuple[str, ...] = ()
    words: tuple[str, ...] = ()


@dataclass(frozen=True)
class Region:
    id: str
    name: str
    keywords: tuple[str, ...] = ()


@dataclass(frozen=True)
class PrefixRule:
    prefix: str
    category: str


@dataclass(frozen=True)
class RuleSet:
    categories: tuple[Category, ...]
    regions: tuple[Region, ...]
    award_codes: tuple[PrefixRule, ...] = ()
    activity_codes: tuple[PrefixRule, ...] = ()
    capital: str = "budapest"
    category_ids: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "category_ids", tuple(c.id for c in self.categories))


def folded_keywords(keywords) -> list[str]:
    """Distinct keywords without case and accents, blanks around them cut."""
    return sorted({fold_str(k) for k in keywords if fold_str(k).strip()})


def word_pattern(words: list[str]) -> str:
    """Any of the words, between characters that are no letters or digits."""
    alternatives = "|".join(re.escape(w.strip()) for w in words)
    return r"(?<![\p{L}\p{N}])(?:" + alternatives + r")(?![\p{L}\p{N}])"


# Fixed values, part of the data contract: ids, names, keywords and prefixes decide which
# category and region a record gets, and their order decides which comes first. Keywords
# are compared without case and accents, so each stands once, in its accented spelling.
CATEGORIES = (
    Category("cleaning", "Takarítás",
             ("takarít", "tisztít", "higién", "irodatakar", "janitor"), ("clean", "cleaning")),
    Category("hvac", "HVAC / klíma karbantartás",
             ("klíma", "légkondi", "hűtés", "fűtés", "szellőz", "ventilat"),
             ("hvac", "air condition", "cooling", "heating")),
    Category("security", "Őrzés-védelem",
             ("őrzés", "biztonsági", "biztonsag", "vagyonvéd", "portaszolgálat", "beléptet"), ("security", "guard")),
    Category("occupational-safety", "Munkavédelem",
             ("munkavéd", "kockázatértékel", "üzemorvos", "munkabiztons"),
             ("occupational safety", "workplace safety", "risk assessment")),
    Category("fire-safety", "Tűzvédelem", ("tűzvéd", "tűzoltó", "tűzjelz", "menekülés"),
             ("fire safety", "fire protection", "fire alarm", "extinguisher")),
    Category("it-support", "IT üzemeltetés / support",
             ("informatik", "rendszergazda", "szerver", "hálózat", "számítógép", "számítástechnik",
              "sysadmin", "helpdesk"),
             ("it", "support", "server", "network", "laptop", "microsoft 365")),
)

REGIONS = (
    Region("budapest", "Budapest", ("budapest", "bp", "főváros")),
    Region("pest", "Pest vármegye",
           ("pest vármegye", "pest megye", "érd", "gödöllő", "vác", "cegléd", "szentendre", "dunakeszi", "budaörs")),
    Region("bacs-kiskun", "Bács-Kiskun", ("kecskemét", "baja", "kiskunfélegyháza")),
    Region("baranya", "Baranya", ("pécs", "mohács")),
    Region("bekes", "Békés", ("békéscsaba", "gyula", "orosháza")),
    Region("borsod-abauj-zemplen", "Borsod-Abaúj-Zemplén", ("miskolc", "ózd", "kazincbarcika")),
    Region("csongrad-csanad", "Csongrád-Csanád", ("szeged", "hódmezővásárhely", "szentes")),
    Region("fejer", "Fejér", ("székesfehérvár", "dunaújváros")),
    Region("gyor-moson-sopron", "Győr-Moson-Sopron", ("győr", "sopron", "mosonmagyaróvár")),
    Region("hajdu-bihar", "Hajdú-Bihar", ("debrecen", "hajdúszoboszló")),
    Region("heves", "Heves", ("eger", "gyöngyös", "hatvan")),
    Region("jasz-nagykun-szolnok", "Jász-Nagykun-Szolnok", ("szolnok", "jászberény")),
    Region("komarom-esztergom", "Komárom-Esztergom", ("tatabánya", "esztergom", "komárom", "tata")),
    Region("nograd", "Nógrád", ("salgótarján", "balassagyarmat")),
    Region("somogy", "Somogy", ("kaposvár", "siófok")),
    Region("szabolcs-szatmar-bereg", "Szabolcs-Szatmár-Bereg", ("nyíregyháza", "mátészalka")),
    Region("tolna", "Tolna", ("szekszárd", "paks")),
    Region("vas", "Vas", ("szombathely", "sárvár", "kőszeg")),
    Region("veszprem", "Veszprém", ("veszprém", "pápa", "ajka", "balatonfüred")),
    Region("zala", "Zala", ("zalaegerszeg", "nagykanizsa", "keszthely")),
)

# Prefixes of the EU procurement vocabulary (CPV).
AWARD_CODES = (
    PrefixRule("9091", "cleaning"), PrefixRule("90919", "cleaning"),
    PrefixRule("45331", "hvac"), PrefixRule("50730", "hvac"), PrefixRule("42500", "hvac"), PrefixRule("42510", "hvac"),
    PrefixRule("7971", "security"), PrefixRule("79713", "security"),
    PrefixRule("71317", "occupational-safety"), PrefixRule("85147", "occupational-safety"),
    PrefixRule("35111", "fire-safety"), PrefixRule("75251", "fire-safety"),
    PrefixRule("72", "it-support"), PrefixRule("50312", "it-support"), PrefixRule("30200", "it-support"),
)

# Prefixes of the NACE rev. 2 activity classes.
ACTIVITY_CODES = (
    PrefixRule("812", "cleaning"), PrefixRule("4322", "hvac"), PrefixRule("3530", "hvac"),
    PrefixRule("80", "security"), PrefixRule("8425", "fire-safety"),
    PrefixRule("620", "it-support"), PrefixRule("6311", "it-support"),
    PrefixRule("9511", "it-support"),
)

DEFAULT_RULES = RuleSet(CATEGORIES, REGIONS, AWARD_CODES, ACTIVITY_CODES)


def _bounded_rows(df: DataFrame, what: str):
    rows = df.limit(MAX_RULE_ROWS + 1).collect()
    if len(rows) > MAX_RULE_ROWS:
        raise ValueError(f"{what}: more than {MAX_RULE_ROWS} rules; not a rule table")
    return rows


def load_rules(category_rules: DataFrame, region_rules: DataFrame,
               prefix_rules: DataFrame | None = None, capital: str = "budapest") -> RuleSet:
    """Rule tables -> rule set.

    category_rules(category, name, ord, keyword, whole_word),
    region_rules(region_id, name, ord, keyword),
    prefix_rules(scheme, prefix, category, ord) with scheme 'cpv' or 'activity'.
    """
    cats: dict[tuple, dict] = {}
    for r in sorted(_bounded_rows(category_rules, "category_rules"), key=lambda r: r["ord"]):
        slot = cats.setdefault((r["category"], r["name"]), {True: [], False: []})
        slot[bool(r["whole_word"])].append(r["keyword"])
    regions: dict[tuple, list] = {}
    for r in sorted(_bounded_rows(region_rules, "region_rules"), key=lambda r: r["ord"]):
        regions.setdefault((r["region_id"], r["name"]), []).append(r["keyword"])
    schemes: dict[str, list] = {"cpv": [], "activity": []}
    if prefix_rules is not None:
        for r in sorted(_bounded_rows(prefix_rules, "prefix_rules"), key=lambda r: r["ord"]):
            schemes[r["scheme"]].append(PrefixRule(r["prefix"], r["category"]))
    return RuleSet(
        tuple(Category(i, n, tuple(kw[False]), tuple(kw[True])) for (i, n), kw in cats.items()),
        tuple(Region(i, n, tuple(kw)) for (i, n), kw in regions.items()),
        tuple(schemes["cpv"]), tuple(schemes["activity"]), capital)
