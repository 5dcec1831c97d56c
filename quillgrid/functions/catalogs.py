"""Rule catalogs. Results depend on these words, weights, labels and their order.

Every operator takes its catalog as a parameter; these are the defaults. First-match catalogs are ordered; words match as
lower-case substrings unless an operator says otherwise.
"""

from __future__ import annotations

STATEWIDE = "Statewide"

#: Region of the data tag, first match.
TAG_REGIONS = [
    ("Mat-Su", ["mat-su", "matanuska", "susitna", "wasilla", "palmer"]),
    ("Southcentral", ["anchorage", "kenai", "soldotna", "homer", "cordova", "whittier", "girdwood", "turnagain"]),
    ("Southeast", ["juneau", "sitka", "ketchikan", "petersburg", "wrangell", "skagway", "haines"]),
    ("Interior", ["fairbanks", "delta", "tok", "north pole"]),
    ("Western Alaska", ["bethel", "nome", "dillingham", "kuskokwim", "yukon"]),
    ("North Slope", ["utqiagvik", "barrow", "north slope", "kotzebue"]),
    ("Gulf Coast", ["kodiak", "valdez", "seward", "prince william sound"]),
]
#: Typed region, first match.
TYPED_REGIONS = [
    ("Yukon-Kuskokwim", ["bethel", "kuskokwim", "yukon", "yk delta", "ykhc", "avcp", "calista", "kwethluk", "aniak"]),
    ("North Slope", ["utqiagvik", "barrow", "north slope", "kotzebue", "prudhoe", "asrc", "arctic slope"]),
    ("Cook Inlet", ["anchorage", "kenai", "soldotna", "homer", "cook inlet", "ciri"]),
    ("Southeast", ["juneau", "sitka", "ketchikan", "petersburg", "wrangell", "skagway", "haines", "sealaska", "ccthita", "searhc"]),
    ("Interior", ["fairbanks", "delta", "tok", "north pole", "doyon", "tanana chiefs"]),
    ("Mat-Su", ["mat-su", "matanuska", "susitna", "wasilla", "palmer"]),
    ("Southwest", ["dillingham", "bristol bay", "bbnc", "bbahc", "king salmon"]),
    ("Gulf Coast", ["kodiak", "valdez", "seward", "cordova", "prince william sound", "kana"]),
    ("Southcentral", ["muldoon", "eagle river", "girdwood", "whittier", "anthc", "southcentral foundation"]),
]
#: Region of archived articles, first match.
ARTICLE_REGIONS = [
    ("Mat-Su", ["mat-su", "matanuska", "susitna", "wasilla", "palmer"]),
    ("Southcentral", ["anchorage", "kenai", "soldotna", "homer", "cordova", "girdwood"]),
    ("Southeast", ["juneau", "sitka", "ketchikan", "petersburg", "wrangell", "skagway"]),
    ("Interior", ["fairbanks", "delta", "tok", "north pole"]),
    ("Western Alaska", ["bethel", "nome", "dillingham", "kuskokwim"]),
    ("North Slope", ["utqiagvik", "barrow", "north slope", "kotzebue"]),
    ("Gulf Coast", ["kodiak", "valdez", "seward"]),
]
#: Region of road events, first match.
ROAD_REGIONS = [
    ("Southcentral", ["anchorage", "muldoon", "tudor", "dimond", "seward hwy"]),
    ("Interior", ["fairbanks", "north pole", "delta", "tok"]),
    ("Southeast", ["juneau", "sitka", "ketchikan", "wrangell", "petersburg"]),
    ("Mat-Su", ["matanuska", "wasilla", "palmer", "mat-su", "willow"]),
    ("Southcentral", ["kenai", "soldotna", "homer", "kachemak"]),
    ("Gulf Coast", ["kodiak", "valdez", "cordova", "seward"]),
    ("Yukon-Kuskokwim", ["bethel", "nome", "dillingham", "yukon"]),
    ("North Slope", ["barrow", "utqia", "north slope", "prudhoe"]),
]
#: Region of dispatch incidents, scanned word by word.
DISPATCH_REGIONS = [
    ("Southcentral", ["soldotna"]), ("Southcentral", ["kenai"]), ("Southcentral", ["homer"]), ("Southcentral", ["anchorage"]),
    ("Gulf Coast", ["kodiak"]), ("Gulf Coast", ["seward"]), ("Mat-Su", ["wasilla"]), ("Mat-Su", ["palmer"]), ("Mat-Su", ["mat-su"]),
    ("Mat-Su", ["matanuska"]), ("Mat-Su", ["big lake"]), ("Mat-Su", ["houston"]), ("Mat-Su", ["sutton"]), ("Interior", ["fairbanks"]),
    ("Interior", ["delta"]), ("Interior", ["north pole"]), ("Interior", ["nenana"]), ("Southeast", ["juneau"]), ("Southeast", ["sitka"]),
    ("Southeast", ["ketchikan"]), ("Southeast", ["wrangell"]), ("Southeast", ["petersburg"]), ("Southeast", ["skagway"]), ("Southeast", ["haines"]),
    ("Western Alaska", ["bethel"]), ("Western Alaska", ["nome"]), ("Western Alaska", ["dillingham"]), ("North Slope", ["kotzebue"]),
    ("North Slope", ["barrow"]), ("North Slope", ["utqiagvik"]), ("Gulf Coast", ["valdez"]), ("Gulf Coast", ["cordova"]), ("Interior", ["glennallen"]),
    ("Interior", ["tok"]), ("Western Alaska", ["mcgrath"]), ("Southwest", ["unalaska"]), ("Southwest", ["king salmon"]), ("Southwest", ["sand point"]),
    ("Southwest", ["cold bay"]),
]

#: Impact score: base, bounds, and rules (weight, "category" or "text", words) that add up.
SCORE_BASE, SCORE_LOW, SCORE_HIGH = 30, 10, 100
SCORE_RULES = [
    (40, "category", ["Emergency", "Safety"]),
    (35, "text", ["tsunami", "earthquake", "eruption", "wildfire", "evacuation", "amber alert"]),
    (25, "text", ["advisory", "warning", "alert", "closure", "emergency order", "declaration"]),
    (20, "category", ["Health"]),
    (20, "text", ["outbreak", "health advisory", "disease", "vaccination", "epidemic"]),
    (18, "category", ["Fisheries"]),
    (20, "text", ["emergency order", "escapement", "run strength", "opener", "fishery closure"]),
    (10, "category", ["Government", "Legal", "Politics"]),
    (15, "text", ["executive order", "legislation", "passed", "signed", "budget", "lawsuit", "ruling"]),
    (8, "category", ["Native"]),
    (12, "text", ["ancsa", "subsistence", "tribal sovereignty", "land rights", "tribal compact"]),
    (10, "category", ["Energy", "Mining"]),
    (15, "text", ["spill", "pipeline", "permit", "project approval", "drilling"]),
    (5, "category", ["Science", "Research"]),
    (-10, "category", ["Recreation", "Social", "Agriculture"]),
]
#: Urgency by least score.
URGENCY = [(80, "now"), (50, "soon")]
URGENCY_DEFAULT = "background"

SECTORS = {
    "Health": "health", "Fisheries": "fisheries", "Energy": "energy", "Mining": "energy", "Emergency": "safety", "Safety": "safety",
    "Government": "governance", "Legal": "governance", "Politics": "governance", "Native": "native-affairs", "Environment": "environment",
    "Wildlife": "environment", "Climate": "environment", "Transportation": "transportation", "Maritime": "transportation", "Research": "research",
    "Science": "research", "Economy": "economy", "Business": "economy", "Labor": "economy", "Agriculture": "subsistence", "Recreation": "subsistence",
    "Education": "research", "Social": "governance", "Industry": "energy", "Parks": "environment", "Forest": "environment", "Radio": "governance",
    "Regional": "governance", "News": "governance",
}
SECTOR_DEFAULT = "governance"

#: Entities, every match.
ENTITIES = [
    ("ykhc", ["ykhc", "yukon-kuskokwim health"]), ("avcp", ["avcp", "association of village council"]), ("ciri", ["ciri", "cook inlet region"]),
    ("anthc", ["anthc", "alaska native tribal health"]), ("searhc", ["searhc", "southeast alaska regional health"]), ("asrc", ["asrc", "arctic slope regional"]),
    ("doyon", ["doyon"]), ("sealaska", ["sealaska"]), ("bbnc", ["bbnc", "bristol bay native"]), ("calista", ["calista"]), ("adfg", ["adf&g", "fish and game", "adfg"]),
    ("nws", ["national weather service", "nws anchorage", "nws fairbanks", "nws juneau"]), ("blm", ["bureau of land management", "blm alaska"]),
    ("tanana", ["tanana chiefs"]), ("maniilaq", ["maniilaq"]), ("norton", ["norton sound health"]), ("kana", ["kodiak area native", "kana"]),
    ("bbahc", ["bristol bay area health", "bbahc"]), ("nana", ["nana regional", "nana corporation"]),
]

#: Feed-name words that exempt an item from the rule on summaries that only repeat the title.
EXEMPT_FEEDS = ["nws", "usgs", "emergency", "tsunami", "earthquake", "alert", "fire", "police", "trooper"]
WEATHER_FEEDS = ["NWS", "Weather"]

#: Category by "/" + word in a URL, first match.
URL_CATEGORIES = [
    ("Safety", ["crime"]), ("Safety", ["courts"]), ("Politics", ["politics"]), ("Environment", ["environment"]), ("Energy", ["oil"]), ("Business", ["business"]),
    ("Economy", ["economy"]), ("Science", ["science"]), ("News", ["alaska-news"]), ("Regional", ["alaska-life"]), ("Recreation", ["outdoors"]),
    ("Weather", ["weather"]), ("News", ["nation"]), ("Regional", ["community"]), ("News", ["stories"]),
]
URL_CATEGORY_DEFAULT = "News"

FISHERIES_TYPES = [
    ("emergency_order", ["emergency order", "eo ", "e.o."]),
    ("closure", ["closure", "closed", "restriction"]),
    ("opening", ["opening", "opened", "opener"]),
    ("sonar_count", ["sonar", "count", "escapement"]),
    ("harvest", ["harvest", "catch", "landings"]),
    ("regulation", ["regulation", "rule", "management"]),
]
FISHERIES_DEFAULT = "update"
SPECIES = [
    ("salmon", ["salmon", "sockeye", "chinook", "king salmon", "coho", "silver", "pink", "chum", "keta"]),
    ("halibut", ["halibut"]),
    ("crab", ["crab", "king crab", "tanner", "opilio", "bairdi"]),
    ("herring", ["herring"]),
    ("pollock", ["pollock"]),
    ("cod", ["cod", "pacific cod"]),
    ("sablefish", ["sablefish", "black cod"]),
]
LEGISLATIVE_ACTIONS = [
    ("committee", ["committee", "hearing", "referred to"]),
    ("floor", ["floor session", "transmitting", "read the first time"]),
    ("executive", ["signed", "vetoed", "enacted", "effective", "governor"]),
    ("introduction", ["introduced", "first reading"]),
    ("passage", ["passed", "approved", "adopted"]),
    ("amendment", ["amendment", "amended", "cosponsor", "cs "]),
]
LEGISLATIVE_DEFAULT = "general"

ALERT_IMPACT = {"Extreme": 100, "Severe": 80, "Moderate": 50, "Minor": 20, "Unknown": 30}
ALERT_IMPACT_DEFAULT = 40
ALERT_URGENCY = {"Immediate": "now", "Expected": "now", "Future": "background", "Past": "background", "Unknown": "background"}
VOLCANO_IMPACT = {"RED": 95, "WARNING": 90, "ORANGE": 75, "WATCH": 70, "YELLOW": 45, "ADVISORY": 40, "GREEN": 10, "NORMAL": 10, "UNASSIGNED": 10}
VOLCANO_DEFAULT = 20
ROAD_URGENCY = {"closures": "now", "closure": "now", "accidentsandincidents": "now", "accidentsAndIncidents": "now", "incident": "now", "roadwork": "background", "construction": "background"}

#: Facilities, whole word in any case, first match.
FACILITIES = [
    ("FCC", "Fairbanks Correctional Center"), ("MSPT", "Mat-Su Pretrial Facility"), ("WCC", "Wildwood Correctional Center"), ("Wildwood", "Wildwood Correctional Complex"),
    ("Hiland", "Hiland Mountain Correctional Center"), ("LCCC", "Lemon Creek Correctional Center"), ("LMCC", "Lemon Creek Correctional Center"),
    ("ANVSA", "Anvil Mountain Correctional Center"), ("Anvil", "Anvil Mountain Correctional Center"), ("KPU", "Ketchikan Pretrial Unit"),
    ("GCCC", "Goose Creek Correctional Center"), ("Goose Creek", "Goose Creek Correctional Center"), ("YYF", "Yukon-Kuskokwim Correctional Center"),
    ("YKCC", "Yukon-Kuskokwim Correctional Center"), ("JBER", "JBER Correctional Facility"), ("AYA", "Alaska Youth Authority"),
]

HIGHWAY_ALIASES = {
    "parks highway": "george parks highway", "parks hwy": "george parks highway", "stewart highway": "stese highway", "rich": "richardson highway",
    "glenn": "glenn highway", "seward": "seward highway", "dalton": "dalton highway", "denali": "denali highway", "elliott": "elliott highway",
    "haines": "haines highway", "sterling": "sterling highway", "tok": "tok cutoff highway", "tok cutoff": "tok cutoff highway", "alaska": "alaska highway",
    "taylor": "taylor highway", "steese": "steese highway", "kodiak": "kodiak", "petersville": "petersville road",
}

REGION_CENTERS = {
    "Mat-Su": (61.58, -149.4), "Matanuska-Susitna": (61.58, -149.4), "Interior": (64.83, -147.71), "Kenai Peninsula": (60.55, -151.25), "Kenai": (60.55, -151.25),
    "Southeast": (58.3, -134.41), "Southcentral": (61.21, -149.9), "Western": (60.79, -161.75), "Northern": (71.29, -156.78), "Statewide": (64.2008, -149.4937),
    "Aleutians": (53.88, -166.53), "Bristol Bay": (58.8, -157.0), "Copper River": (62.1, -145.53), "Prince William Sound": (60.69, -147.16),
}

#: Places, whole word, longest name first.
PLACES = {
    "anchorage": (61.2181, -149.9003), "fairbanks": (64.8378, -147.7164), "juneau": (58.3019, -134.4197), "wasilla": (61.5809, -149.4401), "sitka": (57.0531, -135.33),
    "ketchikan": (55.3422, -131.6461), "kenai": (60.5544, -151.2583), "kodiak": (57.79, -152.4072), "bethel": (60.7922, -161.7558), "palmer": (61.5997, -149.1128),
    "homer": (59.6425, -151.5483), "unalaska": (53.8741, -166.534), "dutch harbor": (53.8906, -166.5292), "barrow": (71.2906, -156.7887), "utqiagvik": (71.2906, -156.7887),
    "soldotna": (60.4878, -151.0583), "valdez": (61.1308, -146.3483), "nome": (64.5011, -165.4064), "kotzebue": (66.8983, -162.5958), "petersburg": (56.8125, -132.9556),
    "seward": (60.1042, -149.4422), "wrangell": (56.4708, -132.3767), "dillingham": (59.0397, -158.4575), "cordova": (60.5428, -145.7575), "haines": (59.2358, -135.445),
    "skagway": (59.4583, -135.3139), "delta junction": (64.0378, -145.7317), "delta": (64.0378, -145.7317), "glennallen": (62.1103, -145.55), "tok": (63.3367, -142.9856),
    "north pole": (64.7511, -147.3494), "nenana": (64.5619, -149.0983), "mcgrath": (62.9564, -155.5958), "king salmon": (58.6883, -156.6492), "sand point": (55.3392, -160.4969),
    "cold bay": (55.2003, -162.7147), "yakutat": (59.5469, -139.7272), "girdwood": (60.9576, -149.1558), "turnagain": (60.95, -149.2), "houston": (61.6311, -149.8169),
    "sutton": (61.7103, -148.8872), "big lake": (61.5342, -149.9511), "aniak": (61.5817, -159.5331), "craig": (55.4769, -133.1483), "emmonak": (62.7761, -164.5375),
    "galena": (64.7336, -156.9205), "klawock": (55.5528, -133.0906), "st. marys": (62.0522, -163.1678),
}

#: Agencies, upper-case substring, first match.
AGENCY_PLACES = [
    ("ANCHORAGE", (61.2181, -149.9003)), ("PALMER", (61.5997, -149.1128)), ("FAIRBANKS", (64.8378, -147.7164)), ("SOLDOTNA", (60.4878, -151.0583)),
    ("WASILLA", (61.5809, -149.4411)), ("JUNEAU", (58.3019, -134.4197)), ("ANCHOR POINT", (59.7767, -151.8314)), ("KENAI", (60.5544, -151.2583)),
    ("HOMER", (59.6425, -151.5483)), ("SEWARD", (60.1042, -149.4422)), ("NORTH POLE", (64.7511, -147.3494)), ("NENANA", (64.5619, -149.0967)),
    ("DELTA JUNCTION", (64.0378, -145.7319)), ("WAINWRIGHT", (64.8213, -147.6047)), ("AIRPORT", (61.1751, -149.9964)), ("KODIAK", (57.79, -152.4072)),
    ("KETCHIKAN", (55.3422, -131.6461)), ("SITKA", (57.0531, -135.33)), ("BETHEL", (60.7922, -161.7558)), ("NOME", (64.5011, -165.4064)), ("MAT SU", (61.5809, -149.4411)),
]

#: Parts that an agency's name loses, in this order; words that make it one city; that city.
AGENCY_NOISE = ["AST ENFORCEMENT", "AST ENFRCMENT RURAL", "AST INVESTIGATIONS", "POLICE DEPARTMENT", "POLICE DEPT/WARRANTS", "AIRPORT POLICE/FIRE", "BOROUGH", "AWT", "DPS", "AST"]
AGENCY_CITY_WORDS, AGENCY_CITY, AGENCY_UNKNOWN = ["ANCH", "ABI MISSING PERSONS"], "Anchorage", "Unknown"

#: Parts of URLs that are no articles, and the words and endings of feed candidates.
NO_ARTICLE = ["/tag/", "/category/", "/author/", "/about", "/contact", "login", "signup", "/rss"]
FEED_ENDINGS = [".xml", ".rss", ".atom", "/feed", "/rss"]
FEED_WORDS = ["feed", "rss", "atom", "blog", "news", "articles", "press", "media", "updates", "stories", "posts"]

SNIPPET_EMPTY = "Open article for full details at source."
