"""Fixed values that results depend on: word lists and lookup tables, in natural order."""

from __future__ import annotations

# Legal endings of company names.
LEGAL_SUFFIXES = (
    "co", "company", "group", "holding", "holdings",
    "pty ltd", "p/l", "proprietary limited", "ltd", "limited", "nl", "n.l.", "no liability", "Ltd/Australia", "Limited/Australia",
    "inc", "incorporated", "corp", "corporation", "plc", "llc", "llp", "pty",
    "bv", "b.v.", "sa", "s.a.", "gmbh", "g.m.b.h.", "ag", "kk", "k.k.", "gk", "g.k.", "srl", "s.r.l.", "sarl", "s.a.r.l.", "spa", "s.p.a.",
    "s de rl", "s. de r.l.", "oy", "ab", "as",
    "ltda", "s de rl de cv", "s. de r.l. de c.v.",
    "pte ltd", "pte limited", "pte", "b c ltd", "b c limited", "l.p.", "lp", "sac", "s.a.c.", "sas", "s.a.s.",
)

# One spelling for words of company names.
WORD_SPELLINGS = {
    "australia": "au",
    "aluminium": "aluminum",
    "sulphur": "sulfur",
    "haematite": "hematite",
    "resources": "resource",
    "minerals": "mineral",
    "steels": "steel",
    "diamonds": "diamond",
}

# Names that match too much.
DIRTY_NAMES = ("minerals", "mining corp", "group engineering pty ltd", "minerals corporation")

# Project status by kind of project.
STATUS_GROUPS = {
    "Mine Projects": ("mineral deposit", "mining", "new mine", "mine expansion", "operating mine", "under development", "care and maintenance", "historic mine", "closed"),
    "Processing Projects": ("processing",),
    "Infrastructure Projects": ("infrastructure",),
    "Feasibility Studies": ("scoping", "pre-feasibility", "feasibility", "definitive feasibility", "bankable feasibility"),
}

# Abbreviations of states.
STATES = {
    "Western Australia": "WA",
    "Queensland": "QLD",
    "South Australia": "SA",
    "New South Wales": "NSW",
    "Tasmania": "TAS",
    "Victoria": "VIC",
    "Northern Territory": "NT",
    "Australian Capital Territory": "ACT",
    "Indian Ocean Territories": "IOT",
}

# The order of countries in company lists; others come last.
COUNTRY_ORDER = ("Australia", "United States", "China", "United Kingdom", "France", "Japan", "Canada", "Mexico", "Saudi Arabia", "India", "South Africa", "Korea, Republic of", "Brazil")

# Kinds of geological province that become columns.
PROVINCE_KINDS = ("igneous", "metallogenic", "sedimentary", "tectonic")

# Columns of market data, of unified projects, and of enriched projects.
MARKET_COLUMNS = (
    "Ticker", "Short Name", "Country of Domicile", "Company Type", "Market Cap", "Revenue:Y", "Tot Assets:Y", "Number of Employees:LF",
    "ICB Sector", "ICB Subsector", "GICS Industry", "GICS SubIndustry", "BICS L3 Industry", "BICS L4 Sub Industry", "BICS L5 Segment", "BICS L6 Segment",
)
PROJECT_COLUMNS = (
    "ENO", "DEPOSIT_NAME", "SYNONYMS", "STATE", "LONG_GDA94", "LAT_GDA94", "ACCURACY_M", "OPERATING_STATUS", "COMMODITY_PRIMARY", "COMMODITY_SECONDARY",
    "COMMODITY_NAMES", "COMPANIES", "COMPANY_WEBSITES", "PROVINCES", "GEOLOGIC_AGE", "DEPOSIT_MODEL", "DEPOSIT_MODEL_ENVIRONMENT", "DEPOSIT_MODEL_GROUP", "DEPOSIT_MODEL_TYPE",
)
ENRICHED_COLUMNS = (
    "ENO", "PROJECT_NAME", "SYNONYMS", "STATE", "LGA", "LONG_GDA94", "LAT_GDA94", "PROJECT_TYPE", "COMMODITY_PRIMARY", "COMMODITY_SECONDARY", "COMMODITY_NAMES",
    "COMPANIES", "GEOLOGIC_AGE", "DEPOSIT_MODEL_ENVIRONMENT", "DEPOSIT_MODEL_GROUP", "DEPOSIT_MODEL_TYPE", "PROVINCES", "IGNEOUS", "METALLOGENIC", "SEDIMENTARY", "TECTONIC",
)
