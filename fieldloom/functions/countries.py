"""Names and codes of countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Usual names and the standard's names.
CORRECTIONS = {
    "Russia": "Russian Federation", "Syria": "Syrian Arab Republic", "South Korea": "Korea, Republic of", "North Korea": "Korea, Democratic People's Republic of",
    "Korea": "Korea, Republic of", "Iran": "Iran, Islamic Republic of", "Vietnam": "Viet Nam", "Venezuela": "Venezuela, Bolivarian Republic of",
    "Bolivia": "Bolivia, Plurinational State of", "Moldova": "Moldova, Republic of", "Laos": "Lao People's Democratic Republic", "Brunei": "Brunei Darussalam",
    "Czech Republic": "Czechia", "Ivory Coast": "Côte d'Ivoire", "Cape Verde": "Cabo Verde", "Swaziland": "Eswatini", "Macau": "Macao",
    "Taiwan": "Taiwan, Province of China", "Tanzania": "Tanzania, United Republic of", "UK": "United Kingdom", "Palestine": "Palestine, State of",
    "Micronesia": "Micronesia, Federated States of", "Bahamas": "Bahamas, The", "São Tomé and Príncipe": "Sao Tome and Principe", "Turkiye": "Turkey",
    "Türkiye": "Turkey", "Congo (Democratic Republic)": "Congo, The Democratic Republic of the", "Congo (Congo-Brazzaville)": "Congo", "Burma": "Myanmar",
    "East Timor": "Timor-Leste", "Saint Kitts": "Saint Kitts and Nevis", "Saint Vincent": "Saint Vincent and the Grenadines", "Saint Lucia": "Saint Lucia",
    "Antigua": "Antigua and Barbuda", "Trinidad": "Trinidad and Tobago", "Slovak Republic": "Slovakia", "Vatican": "Holy See",
}

# Some of the standard's names with their two- and three-letter codes; a full table can be given instead.
ISO = [
    ("Argentina", "AR", "ARG"), ("Australia", "AU", "AUS"), ("Austria", "AT", "AUT"), ("Belgium", "BE", "BEL"), ("Brazil", "BR", "BRA"), ("Canada", "CA", "CAN"),
    ("Chile", "CL", "CHL"), ("China", "CN", "CHN"), ("Colombia", "CO", "COL"), ("Czechia", "CZ", "CZE"), ("Denmark", "DK", "DNK"), ("Egypt", "EG", "EGY"),
    ("Finland", "FI", "FIN"), ("France", "FR", "FRA"), ("Germany", "DE", "DEU"), ("Greece", "GR", "GRC"), ("India", "IN", "IND"), ("Indonesia", "ID", "IDN"),
    ("Iran, Islamic Republic of", "IR", "IRN"), ("Ireland", "IE", "IRL"), ("Italy", "IT", "ITA"), ("Japan", "JP", "JPN"), ("Kenya", "KE", "KEN"),
    ("Korea, Republic of", "KR", "KOR"), ("Mexico", "MX", "MEX"), ("Morocco", "MA", "MAR"), ("Netherlands", "NL", "NLD"), ("New Zealand", "NZ", "NZL"),
    ("Nigeria", "NG", "NGA"), ("Norway", "NO", "NOR"), ("Pakistan", "PK", "PAK"), ("Peru", "PE", "PER"), ("Poland", "PL", "POL"), ("Portugal", "PT", "PRT"),
    ("Romania", "RO", "ROU"), ("Russian Federation", "RU", "RUS"), ("Slovakia", "SK", "SVK"), ("South Africa", "ZA", "ZAF"), ("Spain", "ES", "ESP"),
    ("Sweden", "SE", "SWE"), ("Switzerland", "CH", "CHE"), ("Taiwan, Province of China", "TW", "TWN"), ("Thailand", "TH", "THA"), ("Turkey", "TR", "TUR"),
    ("Ukraine", "UA", "UKR"), ("United Kingdom", "GB", "GBR"), ("United States", "US", "USA"), ("Viet Nam", "VN", "VNM"),
]
NOT_FOUND = "Country not found"


def correct_country(c: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in CORRECTIONS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, c), c)


def iso_table(spark: SparkSession, rows: list[tuple[str, str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(rows or ISO, "name string, alpha2 string, alpha3 string")


def with_codes(df: DataFrame, country: str, iso: DataFrame) -> DataFrame:
    """Adds iso2 and iso3 of a country's name. AQE broadcasts the table if it is as small as it should be."""
    kosovo = F.col(country) == "Kosovo"
    codes = iso.select(F.col("name").alias("__name"), F.col("alpha2").alias("__a2"), F.col("alpha3").alias("__a3"))
    joined = df.join(codes, F.col(country) == F.col("__name"), "left")
    code = lambda c, special: F.when(kosovo, special).otherwise(F.coalesce(c, F.lit(NOT_FOUND)))
    return joined.select(*df.columns, code(F.col("__a2"), "XK").alias("iso2"), code(F.col("__a3"), "XKX").alias("iso3"))


def with_country_name(df: DataFrame, iso3: str, iso: DataFrame) -> DataFrame:
    """Adds country_name of a three-letter code in any case, null for an unknown one."""
    names = iso.select(F.col("alpha3").alias("__a3"), F.col("name").alias("country_name"))
    return df.join(names, F.upper(iso3) == F.col("__a3"), "left").drop("__a3")
