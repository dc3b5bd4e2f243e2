"""Vocabularies of the place-name domain."""

from __future__ import annotations

# Variant kanji and their modern forms.
VARIANTS = {
    "澤": "沢", "瀧": "滝", "嶋": "島", "嵨": "島", "﨑": "崎", "邊": "辺", "邉": "辺", "櫻": "桜", "藪": "薮", "曾": "曽",
    "圓": "円", "國": "国", "驛": "駅", "濱": "浜", "淵": "渕", "藏": "蔵", "臺": "台", "巖": "巌", "峯": "峰", "龍": "竜",
    "拔": "抜", "彌": "弥", "廣": "広", "澁": "渋", "壽": "寿", "萬": "万", "禮": "礼", "數": "数", "體": "体",
}

# Characters that connect the parts of a name.
CONNECTIVES = {"ヶ": "ケ", "ケ": "ケ", "ガ": "ケ", "が": "ケ", "之": "ノ", "乃": "ノ", "の": "ノ", "ノ": "ノ"}

# Prefectures in code order, 01 to 47.
PREFECTURES = (
    "北海道 青森県 岩手県 宮城県 秋田県 山形県 福島県 茨城県 栃木県 群馬県 埼玉県 千葉県 東京都 神奈川県 新潟県 富山県 石川県 福井県 山梨県 長野県"
    " 岐阜県 静岡県 愛知県 三重県 滋賀県 京都府 大阪府 兵庫県 奈良県 和歌山県 鳥取県 島根県 岡山県 広島県 山口県 徳島県 香川県 愛媛県 高知県 福岡県"
    " 佐賀県 長崎県 熊本県 大分県 宮崎県 鹿児島県 沖縄県"
).split()

# Hazard codes and their labels, in order.
HAZARDS = {
    "landslide": "地すべり", "debris_flow": "土石流", "rockfall": "落石", "slope_failure": "崖崩れ・斜面崩壊", "flood": "洪水・河川氾濫",
    "inundation": "浸水・内水・低湿", "tsunami": "津波", "storm_surge": "高潮", "soft_ground": "軟弱地盤・液状化", "avalanche": "雪崩",
    "erosion": "侵食", "volcanic": "火山", "earthquake": "地震", "wind": "強風", "other": "その他",
}

# Keywords of hazards, in the order in which they are tried.
HAZARD_KEYWORDS = [
    ("土石流", "debris_flow"), ("地すべり", "landslide"), ("地滑り", "landslide"), ("山崩れ", "slope_failure"), ("崖崩れ", "slope_failure"),
    ("崩壊", "slope_failure"), ("崩れ", "slope_failure"), ("落石", "rockfall"), ("土砂", "debris_flow"), ("津波", "tsunami"),
    ("高潮", "storm_surge"), ("洪水", "flood"), ("氾濫", "flood"), ("水害", "flood"), ("浸水", "inundation"), ("内水", "inundation"),
    ("湿地", "soft_ground"), ("軟弱", "soft_ground"), ("液状化", "soft_ground"), ("雪崩", "avalanche"), ("侵食", "erosion"), ("浸食", "erosion"),
    ("噴火", "volcanic"), ("火山", "volcanic"), ("地震", "earthquake"), ("強風", "wind"), ("竜巻", "wind"),
]

# Wording of explanations that names a disaster, a terrain, or an administrative change.
DISASTER_MARKERS = (
    "崩壊地名 災害地名 土石流 山崩れ 土砂崩れ 土砂崩 崖崩れ 地すべり 地滑り 崩壊 崩れ 落石 雪崩 洪水 氾濫 水害 浸水 冠水 押し出 押出 津波 決壊 流失 流され 埋まって 埋って 埋立"
).split()
TERRAIN_MARKERS = "湿地 低湿 急傾斜 傾斜地 崖 段丘 くぼ 窪 川原 河原 土手 水はけ 沼 泥 沢の水 溜池 堆積".split()
ADMIN_MARKERS = "地租改正 町村制 合併し".split()

# Words for landforms and for disasters in the sources.
LANDFORM_WORDS = (
    "崖 岸 窪 窪地 久保 凹 谷 谷地 谷戸 谿 渓 澤 沢 洲 渚 浦 灣 湾 潟 河原 川原 磧 州崎 砂洲 砂丘 沼 濕地 湿地 泥 沮洳 深田 泥田 低地 低濕 低湿 窊 傾斜 斜面"
    " 段丘 山腹 山麓 扇狀地 扇状地 三角洲 河口 淵 土砂 水邊 水辺 急峻 峻嶮 險岨 険阻 岩石 巖石 低き 低く 低し くぼ クボ 湫 萢 潦 汀 砂地 沙地 廢川 廃川 河身 河道 堤"
    " 堤防 水底 遊水 溜池 湛"
).split()
DISASTER_WORDS = (
    "崩壞 崩壊 崩落 崩れ 崩地 崩潰 山崩 崖崩 山抜 山津浪 土石流 地すべり 地滑り 落石 雪崩 洪水 水害 出水 氾濫 汎濫 決潰 決壞 決壊 流失 押出 押流 欠崩 浸水 冠水 水沒 水没"
    " 津浪 津波 海嘯 高潮 地震 噴火 泥流 埋沒 埋没 埋り 埋まっ 埋め 埋立 埋 陷沒 陥没 陷落 陥落 沈下 溺 水死 溺死 流死 漂流 液狀化 液状化"
).split()

# Endings of natural features, and tails that printed headings drop.
FEATURE_ENDINGS = "沢 澤 山 川 谷 峠 池 滝 岳 峰 島 岬 浜 湖 沼".split()
HEADING_TAILS = ["", *"郷 村 郡 川 山 浦 島 荘 庄 城 町 原 崎 岳 嶽 池 神社 城址".split()]

# How precisely an attribute locates a name, on old maps and in the gazetteer.
MAP_PRECISION = {"字": "koaza", "町": "oaza", "村": "village", "郷・里": "village", "荘園・新田": "village"}
ENTRY_PRECISION = {**MAP_PRECISION, "郡": "municipality", "市": "municipality", "区": "municipality", "県": "prefecture", "国": "prefecture", "地方": "prefecture"}

# Entries that are no places, and attributes of old-map names that are screened.
NOT_PLACES = "建物 地名以外 判別不能".split()
NOT_SITES = "旧跡 名所・名勝 墓地 その他（名所旧跡） 人名 産業名 国 郡 県 市 区 地方".split()
MAP_ATTRIBUTES = "字 村 町 郷・里 荘園・新田 その他（行政地名） 谷 浜 坂".split()

# Evidence that speaks of a name's origin; relations of a record, strongest first.
RELATIONS = ["named_after", "same_place_record", "nearby_record"]
