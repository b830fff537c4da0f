"""Labels, thresholds and word lists of the warehouse.

Fixed values: these must equal the values the original warehouse uses,
otherwise its results cannot be reproduced. They are stated here once, in
their natural order, and every other module imports them.
"""

# --- fixed values -----------------------------------------------------------

# Raw CSV headers and the snake_case names they are loaded as.
POI_HEADER_RENAMES = {
    "Encrypted_ID": "poi_id",
    "Name_ZH": "name_zh",
    "Name_EN": "name_en",
    "City_ZH": "city_zh",
    "City_EN": "city_en",
    "Latitude_GCJ02": "latitude",
    "Longitude_GCJ02": "longitude",
    "Label_ZH": "label_zh",
    "Label_EN": "label_en",
}
TRIP_HEADER_RENAMES = {
    "Anonymized_Blog_ID": "blog_id",
    "Retrieval_Date": "retrieval_date",
    "Departure_Date": "departure_date",
    "Travel_Partners": "travel_partners",
    "Visit_Sequence": "visit_sequence",
}

# Mainland bounding box, inclusive on both ends.
LATITUDE_RANGE = (4.0, 54.0)
LONGITUDE_RANGE = (73.0, 135.0)

# Years kept: first year inclusive, last bound exclusive (2011 to 2021).
YEAR_RANGE = (2011, 2022)

DEPARTURE_DATE_PATTERN = "yyyy/M/d"
LIST_SEPARATOR = ";"
TRIP_ID_SEPARATOR = "_"

NO_LABEL = "无标签"            # fill for a missing POI label
UNRECORDED_PARTNER = "Unrecorded"  # fill for a missing travel partner
SOLO = "Solo"

# Region rules, first match wins; latitude a, longitude o.
# (label, lat_min, lat_below, lat_at_most, lon_min, lon_below)
REGION_NORTHEAST = "东北"
REGION_NORTH = "华北"
REGION_NORTHWEST = "西北"
REGION_EAST = "华东"
REGION_CENTRAL = "华中"
REGION_SOUTH = "华南"
REGION_SOUTHWEST = "西南"  # default
REGION_BOXES = [
    (REGION_NORTHEAST, 40, None, None, 120, None),
    (REGION_NORTH, 35, 40, None, 110, 120),
    (REGION_NORTHWEST, 35, None, None, None, 110),
    (REGION_EAST, 28, 35, None, 115, None),
    (REGION_CENTRAL, 28, 35, None, 110, 115),
    (REGION_SOUTH, None, None, 28, 110, None),
]

# Category rules, first match wins, regex search on the whole label text.
CATEGORY_PATTERNS = [
    ("主题游乐", "乐园|游乐场|漂流|拓展|骑行|露营|欢乐谷|方特|主题体验"),
    ("文化场馆", "博物馆|美术馆|纪念馆|展览馆|科技馆|影视基地|故居|名人故居"),
    ("历史人文古迹", "古镇|古城|古建|古建筑|寺庙|石窟|园林|古村落|城墙|文物古迹|历史遗址|古战场|老城|文庙|道观"),
    ("都市地标", "城市地标|地标建筑|城市标志建筑|高楼|摩天轮|网红打卡点"),
    ("都市休闲", "公园|商圈|步行街|广场|绿地|城市公园"),
    ("乡村生态", "乡村|农庄|农家乐|采摘|田园|民俗村"),
    ("自然风光", "山|河|江|湖|海|瀑布|草原|峡谷|海滩|海岛|红树林|温泉|生态|山水|风景|自然景观|湖泊|江河|溪流|湿地|森林|花海|赏花"),
]
UNCLASSIFIED = "未分类"   # category of a POI whose label is the no-label fill
OTHER_CATEGORY = "其他景点"  # default category

# Quarter travel level by distinct trips: >=4 high, 2-3 mid, else low.
LEVEL_HIGH = "高频"
LEVEL_MID = "中频"
LEVEL_LOW = "低频"

# Activity range.
RANGE_NATIONAL = "全国型"
RANGE_REGIONAL = "区域型"
RANGE_SINGLE_CITY = "单城型"

# Quarter-over-quarter flag.
RISING_YES = "是"
RISING_NO = "否"
RISING_NO_PREVIOUS = "无上期数据"
RISING_THRESHOLD = 0.3

RATIO_DIGITS = 4
PORTRAIT_DIGITS = 2
TOP_ATTRACTIONS = 50
TOP_CITIES = 10

# --- end of fixed values ----------------------------------------------------
