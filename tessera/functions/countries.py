"""Country names of ISO 3166-1 by two-letter code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names of the standard that differ from the common English ones.
STANDARD_NAMES = {
    "AG": "Antigua and Barbuda", "BA": "Bosnia and Herzegovina", "BL": "Saint Barthélemy", "BN": "Brunei Darussalam", "BO": "Bolivia, Plurinational State of",
    "BQ": "Bonaire, Sint Eustatius and Saba", "CD": "Congo, The Democratic Republic of the", "CG": "Congo", "CI": "Côte d'Ivoire", "CV": "Cabo Verde",
    "FK": "Falkland Islands (Malvinas)", "FM": "Micronesia, Federated States of", "GS": "South Georgia and the South Sandwich Islands", "HK": "Hong Kong",
    "HM": "Heard Island and McDonald Islands", "IR": "Iran, Islamic Republic of", "KN": "Saint Kitts and Nevis", "KP": "Korea, Democratic People's Republic of",
    "KR": "Korea, Republic of", "LA": "Lao People's Democratic Republic", "LC": "Saint Lucia", "MD": "Moldova, Republic of", "MF": "Saint Martin (French part)",
    "MM": "Myanmar", "MO": "Macao", "PM": "Saint Pierre and Miquelon", "PN": "Pitcairn", "PS": "Palestine, State of", "RU": "Russian Federation",
    "SH": "Saint Helena, Ascension and Tristan da Cunha", "SJ": "Svalbard and Jan Mayen", "ST": "Sao Tome and Principe", "SX": "Sint Maarten (Dutch part)",
    "SY": "Syrian Arab Republic", "TC": "Turks and Caicos Islands", "TR": "Türkiye", "TT": "Trinidad and Tobago", "TW": "Taiwan, Province of China",
    "TZ": "Tanzania, United Republic of", "UM": "United States Minor Outlying Islands", "VA": "Holy See (Vatican City State)", "VC": "Saint Vincent and the Grenadines",
    "VE": "Venezuela, Bolivarian Republic of", "VG": "Virgin Islands, British", "VI": "Virgin Islands, U.S.", "VN": "Viet Nam", "WF": "Wallis and Futuna",
}


def country_names(spark: SparkSession) -> dict[str, str]:
    """Code -> name for every code of the standard: the Java library's English name, or the standard's where that differs."""
    locale = spark.sparkContext._jvm.java.util.Locale
    return {c: STANDARD_NAMES.get(c) or locale("", c).getDisplayCountry(locale.ENGLISH) for c in locale.getISOCountries()}


def countries(spark: SparkSession) -> DataFrame:
    """code, name."""
    return spark.createDataFrame(sorted(country_names(spark).items()), "code string, name string")
