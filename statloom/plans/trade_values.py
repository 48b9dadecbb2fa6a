"""Fixed values of the trade tables: label rules, regions, code groups and chapter names.

These decide which label or group a record gets, so they are kept as plain lists in rule
order. Patterns are searched for anywhere in the upper-cased label.
"""

HS_DIGITS = 6
HS_MIN_LENGTH = 10  # codes at least this long belong to the harmonised era

SEMI_PREFIXES = ["8541", "8542"]
MINERAL_CHAPTERS = ["25", "26", "27", "74", "75", "78", "79", "80"]
MINERAL_HEADINGS = ["7108"]

# canonical country: (pattern, exact labels, pattern that must not match, pattern that
# must also match, result)
COUNTRY_RULES = [
    (r"UNITED STATES|^USA$|^U\.?S\.?A?\.?$",
     ["ALASKA", "HAWAII", "PUERTO RICO", "GUAM", "AMERICAN SAMOA"], None, None, "UNITED STATES"),
    (r"HONG ?KONG", [], None, None, "HONG KONG"),
    (r"MACAU|MACAO", [], None, None, "MACAU"),
    (r"TAIWAN|CHINESE TAIPEI|FORMOSA", [], None, None, "TAIWAN"),
    (r"JAPAN|OKINAWA|NANSEI", [], None, None, "JAPAN"),
    (r"KOREA", [], None, r"DPR|NORTH|DEMO\.|DEMOCRATIC PEOPLE", "KOREA, DPR (NORTH)"),
    (r"KOREA", [], None, None, "KOREA, REP. (SOUTH)"),
    (r"^CHINA|MAINLAND CHINA|PEOPLE.?S REP.*CHINA|REPUBLIC OF CHINA$", [], r"TAIWAN", None, "CHINA"),
    (r"GERMAN", [], r"OPT\. CTRY", None, "GERMANY"),
    (r"UNITED KINGDOM|GREAT BRITAIN|^U\.?K\.?$|^UK ", [], None, None, "UNITED KINGDOM"),
    (r"RUSSIA|USSR|SOVIET", [], None, None, "RUSSIA"),
    (r"NETHERLANDS", [], r"ANTILLES", None, "NETHERLANDS"),
    (r"CZECH", [], None, None, "CZECH REPUBLIC"),
    (r"SLOVAK", [], None, None, "SLOVAKIA"),
    (r"VIET ?NAM", [], None, None, "VIETNAM"),
    (r"BRUNEI", [], None, None, "BRUNEI DARUSSALAM"),
    (r"^LAO|LAO PEOPLE", [], None, None, "LAOS"),
    (r"MYANMAR|BURMA", [], None, None, "MYANMAR"),
    (r"CAMBODIA|KAMPUCHEA", [], None, None, "CAMBODIA"),
    (r"INDONESIA", [], None, None, "INDONESIA"),
    (r"MALAYSIA|MALAYA|SABAH|SARAWAK", [], None, None, "MALAYSIA"),
    (r"ARAB EMIRATES|^U\.?A\.?E", [], None, None, "UNITED ARAB EMIRATES"),
    (r"IRAN", [], None, None, "IRAN"),
]

RESIDUAL_RX = (
    r"N\.E\.S|NOT SPECIFIED|NEUTRAL ZONE|OPT\. CTRY|OTHER PACIFIC ISLANDS|U\.S\. OCEANIA|"
    r"FRENCH OCEANIA|SPANISH AFRICA|BRITISH PACIFIC ISLANDS|PACIFIC TRUST|"
    r"SOUTH AND SOUTHEAST ASIA"
)
RESIDUAL_NOT_RX = "ARAB EMIRATES"

EUROPE_RX = (
    "AUSTRIA|BELGIUM|BULGARIA|CROATIA|CYPRUS|CZECH|DENMARK|ESTONIA|FINLAND|FRANCE|GERMAN|"
    "GREECE|HUNGARY|ICELAND|IRELAND|ITALY|LATVIA|LIECHTENSTEIN|LITHUANIA|LUXEMBOURG|MALTA|"
    "NETHERLANDS|NORWAY|POLAND|PORTUGAL|ROMANIA|SLOVAK|SLOVENIA|SPAIN|SWEDEN|SWITZERLAND|"
    "UNITED KINGDOM|GREAT BRITAIN"
)
EUROPE_NOT_RX = "ANTILLES|NEW CALEDONIA|GUIANA|POLYNESIA"

ASEAN = [
    "INDONESIA", "MALAYSIA", "THAILAND", "SINGAPORE", "VIETNAM", "BRUNEI DARUSSALAM",
    "CAMBODIA", "MYANMAR", "LAOS",
]
EAST_ASIA = [
    "CHINA", "HONG KONG", "JAPAN", "TAIWAN", "MACAU", "KOREA, REP. (SOUTH)",
    "KOREA, DPR (NORTH)", "MONGOLIA",
]
NORTH_AMERICA = ["UNITED STATES", "CANADA", "MEXICO"]
OCEANIA = ["AUSTRALIA", "NEW ZEALAND", "PAPUA NEW GUINEA"]
MIDDLE_EAST_RX = (
    "SAUDI|EMIRATES|QATAR|KUWAIT|BAHRAIN|OMAN|ISRAEL|IRAN|IRAQ|JORDAN|LEBANON|SYRIA|YEMEN|TURKEY"
)
SOUTH_ASIA_RX = "INDIA|PAKISTAN|BANGLADESH|SRI LANKA|NEPAL"

# first chapter, last chapter, group
CHAPTER_GROUPS = [
    (1, 5, "Animal products"),
    (6, 15, "Vegetable products & oils"),
    (16, 24, "Prepared food, beverages & tobacco"),
    (25, 27, "Mineral products"),
    (28, 38, "Chemicals"),
    (39, 40, "Plastics & rubber"),
    (41, 49, "Hides, wood & paper"),
    (50, 63, "Textiles & apparel"),
    (64, 67, "Footwear & misc"),
    (68, 71, "Stone, glass & precious metals"),
    (72, 83, "Base metals"),
    (84, 85, "Machinery & electrical"),
    (86, 89, "Transport equipment"),
    (90, 99, "Instruments & misc manufactures"),
]
NO_GROUP = "Other / unclassified"

# prefix, mineral type; the four-digit heading is tested first
MINERAL_TYPES = [
    ("7108", "Gold (7108)"),
    ("26", "Metal ores & concentrates (26)"),
    ("74", "Copper (74)"),
    ("75", "Nickel (75)"),
    ("27", "Mineral fuels (27)"),
    ("25", "Salt, stone & earths (25)"),
    ("78", "Lead, zinc & tin (78-80)"),
    ("79", "Lead, zinc & tin (78-80)"),
    ("80", "Lead, zinc & tin (78-80)"),
]
OTHER_MINERAL = "Other minerals"

CHAPTER_LABELS = {
    "01": "Live animals", "02": "Meat", "03": "Fish & seafood", "04": "Dairy, eggs, honey",
    "05": "Other animal products", "06": "Live trees & plants", "07": "Vegetables",
    "08": "Edible fruit & nuts", "09": "Coffee, tea & spices", "10": "Cereals",
    "11": "Milling products", "12": "Oil seeds & oleagins", "13": "Gums & resins",
    "14": "Other vegetable materials", "15": "Animal & vegetable fats/oils",
    "16": "Prepared meat & fish", "17": "Sugars", "18": "Cocoa",
    "19": "Cereal/flour preparations", "20": "Prepared vegetables & fruit",
    "21": "Misc edible preparations", "22": "Beverages & spirits",
    "23": "Food residues & animal feed", "24": "Tobacco", "25": "Salt, stone & cement",
    "26": "Ores, slag & ash", "27": "Mineral fuels & oils", "28": "Inorganic chemicals",
    "29": "Organic chemicals", "30": "Pharmaceuticals", "31": "Fertilisers",
    "32": "Tanning & dyeing extracts", "33": "Essential oils & cosmetics",
    "34": "Soaps & waxes", "35": "Albuminoidal substances", "36": "Explosives",
    "37": "Photographic goods", "38": "Misc chemical products", "39": "Plastics",
    "40": "Rubber", "41": "Raw hides & leather", "42": "Leather articles", "43": "Furskins",
    "44": "Wood & wood articles", "45": "Cork", "46": "Straw & plaiting", "47": "Wood pulp",
    "48": "Paper & paperboard", "49": "Printed books", "50": "Silk", "51": "Wool",
    "52": "Cotton", "53": "Other vegetable fibres", "54": "Man-made filaments",
    "55": "Man-made staple fibres", "56": "Wadding & nonwovens", "57": "Carpets",
    "58": "Special woven fabrics", "59": "Coated textiles", "60": "Knitted fabrics",
    "61": "Knitted apparel", "62": "Woven apparel", "63": "Other textile articles",
    "64": "Footwear", "65": "Headgear", "66": "Umbrellas", "67": "Feathers & art. flowers",
    "68": "Stone & cement articles", "69": "Ceramics", "70": "Glass",
    "71": "Pearls & precious metals", "72": "Iron & steel", "73": "Iron/steel articles",
    "74": "Copper", "75": "Nickel", "76": "Aluminium", "78": "Lead", "79": "Zinc", "80": "Tin",
    "81": "Other base metals", "82": "Tools & cutlery", "83": "Misc base-metal articles",
    "84": "Machinery & mech. appliances", "85": "Electrical machinery & electronics",
    "86": "Railway", "87": "Vehicles", "88": "Aircraft", "89": "Ships & boats",
    "90": "Optical, medical & precision instr.", "91": "Clocks & watches",
    "92": "Musical instruments", "93": "Arms & ammunition", "94": "Furniture & lighting",
    "95": "Toys, games & sports", "96": "Misc manufactured articles", "97": "Works of art",
    "98": "Special transactions (national)", "99": "Special / other (national)",
}
