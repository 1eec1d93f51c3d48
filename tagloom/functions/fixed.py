"""Word lists, patterns, labels and scores that results depend on. Plain data, no logic."""

# --- Fixed values: text layer ---------------------------------------------------------------------------
NOISE_WORDS = ["官方直營", "官方旗艦店", "旗艦店", "官方授權", "官方", "台灣總代理", "總代理", "即期品", "台灣公司貨", "公司貨", "原廠", "正品", "現貨", "免運"]
ORIGIN_PREFIXES = ["紐西蘭", "日本", "韓國", "美國", "法國", "德國", "英國", "澳洲", "義大利", "台灣", "泰國"]
NO_BRAND_WORDS = ["無品牌", "其他", "其它", "副廠", "oem", "nobrand", "none", "無", "通用", "自有品牌", "mit", "白牌", "0"]
GENERIC_WORDS = ["收納", "居家", "生活", "買一送一", "限時", "特價", "熱銷", "新品", "任選", "組合", "入組", "超值", "現貨", "免運", "團購", "禮盒", "必備", "推薦", "精選", "款"]
COMPATIBLE = r"(副廠|通用款|(適用|相容|兼容|for)\s*(iphone|ipad|apple|samsung|switch|airpods|galaxy|macbook|pixel|蘋果|三星|小米))"
ACCESSORY = r"(保護貼|保護殼|保護套|手機殼|鋼化膜|玻璃貼|滿版|皮套|背蓋|空壓殼|支架|杯架|車架|掛架|收納架|置物架|轉接|傳輸線|充電線|充電座|替換|專用|配件|副廠|相容|適用|通用)"
STOP_TOKENS = [
    "the", "body", "shop", "house", "home", "life", "care", "baby", "beauty", "paris", "pro", "professional", "plus", "health", "healthcare", "lab", "labs",
    "official", "store", "company", "international", "taiwan", "japan", "korea", "group", "entertainment", "choice", "goals", "signature", "coffee", "tech",
    "village", "face", "north", "balance", "good", "smile", "mobile", "national", "geographic", "digital", "western", "space", "power", "cook", "dream",
    "trend", "future", "biotech", "educational", "nutrition", "optimum", "nature", "natural", "organic",
]
NOT_BRAND_WORDS = [
    "製造", "台灣製造", "日本製造", "台灣製", "日本製", "超抗刮", "防摔專家", "洗衣機過濾網", "運動相機通用", "鋼化膜", "防窺片", "抗菌", "防水", "透氣",
    "國家", "幸福", "生活", "精品", "時尚", "經典", "自然", "健康", "美麗", "快樂", "溫馨", "農會", "漁會", "合作社", "生產者", "小農", "產地", "批發", "零售",
    "量販", "賣場", "百貨", "超市", "商行", "商店", "專櫃", "專賣店", "直營", "代理", "進口", "外銷", "通用", "萬用", "多功能", "高品質", "高質感", "超值",
    "優惠", "特價", "促銷", "限量", "熱銷", "暢銷", "推薦", "嚴選", "精選", "優選", "良品", "好物", "選物", "雜貨",
    "general", "universal", "standard", "classic", "premium", "quality", "value", "original", "genuine", "official", "nil", "none", "null", "other", "misc", "etc",
]
CATEGORY_WORDS = [
    "收納", "置物", "整理", "清潔", "洗劑", "保養", "護理", "保健", "營養", "食品", "用品", "配件", "工具", "器材", "設備", "零件", "耗材", "文具", "玩具",
    "服飾", "鞋款", "包款", "飾品", "家具", "寢具", "廚具", "餐具", "杯架", "掛勾", "衣架", "保護貼", "手機殼", "充電", "傳輸", "轉接", "電池", "燈具", "照明",
]
SPECIFICATION = r"(\d+\s*(入|組|件|包|盒|片|支|條|個|雙|ml|ML|cc|CC|g|G|kg|KG|cm|CM|mm|吋|寸|L))|([0-9]{3,})"
PROMOTION = r"買[一二三四五六七八九十\d]+送[一二三四五六七八九十\d]+|限時|特價|折扣|折價|免運|促銷|下殺|出清|任選|加購|贈品|熱銷|預購|現貨"
HOST_NAMES = ["apple", "apple蘋果", "蘋果", "samsung", "三星", "sony", "dyson", "nintendo", "任天堂", "小米", "switch", "pixel", "xbox", "ps4", "ps5"]
HOST_FAMILY = r"(apple)?(iphone|ipad|macbook|airpods|applewatch|galaxy|switch)[a-z0-9]*"
HOST_PLATFORMS = ["apple", "iphone", "ipad", "macbook", "airpods", "applewatch", "samsung", "galaxy", "switch", "nintendo", "pixel", "playstation", "ps4", "ps5", "xbox", "sony", "dyson", "蘋果", "三星", "任天堂", "小米"]
HOST_INSIDE = ["iphone", "ipad", "switch", "macbook", "galaxy", "airpods"]

# --- Fixed values: brand index --------------------------------------------------------------------------
SPECIAL_IDS = [0, 99999999]
CORPORATE_SUFFIXES = ["文化", "出版", "出版社", "文創", "事業", "生技", "科技", "國際", "實業", "企業", "有限公司", "股份有限公司", "公司", "圖書", "文庫", "社", "行", "廠", "館", "文化事業", "出版事業", "生物科技", "文教", "傳媒", "媒體", "工作室"]
GENERIC_KEYS = [
    *CORPORATE_SUFFIXES, "書店", "書局", "書版", "書坊", "大學", "學院", "研究所", "基金會", "百貨", "超市", "藥局", "藥妝", "診所", "醫院", "農場", "牧場",
    "食品", "生活", "用品", "精品", "嚴選", "專賣", "旗艦", "選物", "國際企業", "文化出版", "出版集團", "股份",
    "ltd", "limited", "inc", "incorporated", "corp", "corporation", "llc", "plc", "gmbh", "sas", "bv", "pte", "pty", "kk", "ag", "sa", "nv", "srl",
    "publishing", "publishers", "publication", "publications", "press", "books", "editions", "imprint", "enterprise", "enterprises", "industries", "holdings",
    "ation", "ations", "cation", "sion", "ment", "ness",
]
APPLE_NAMES = ["apple", "apple蘋果", "蘋果apple", "iphoneapple", "appleiphone"]
APPLE_PRODUCT = r"iphone(\d+[a-z0-9]*)?"
CHILD_BRANDS = [("kanebo", "kate"), ("asus", "rog")]
AUTO, FUZZY_CUTOFF, MATCH, TIE_GAP = 95, 88, 75, 5
TRUST = {"human": 3, "curated": 2, "natural": 1, "auto": 0}
ALIAS_PRIORITY = {"auto": 1, "curated": 2, "human": 3}
CLUSTER_STOP = ["有限", "公司", "股份", "企業", "國際", "實業", "事業", "科技", "生技", "文化", "出版", "台灣", "中國", "工業", "貿易", "商行", "食品", "生活", "用品", "精品", "嚴選", "專賣", "旗艦"]

# --- Fixed values: outcomes, nodes, reasons, states, bands ----------------------------------------------
POOL, NEW, NONE = "品牌庫品牌", "建議品牌庫新增品牌", "No brand"
REASON_EMPTY, REASON_DESCRIPTION, REASON_COMPATIBLE = "品牌欄與商品名稱皆無品牌", "商品名稱【】為描述非品牌", "相容/副廠配件"
REASON_WORD, REASON_STORE, REASON_OTHER = "品牌欄標示無品牌", "店家/賣場名稱非品牌", "其他(請備註)"
NODES = {
    "1.1": ("品牌欄標示無品牌", NONE), "1.2": ("品牌欄為相容/副廠描述", NONE), "1.3": ("品牌欄完全相符", POOL), "1.4": ("品牌欄相符（品牌庫有重複，取業績最高）", POOL),
    "1.5": ("品牌欄相符（多個不同品牌，需確認）", POOL), "1.6": ("品牌欄有品牌，品牌庫沒有", NEW), "1.7": ("品牌欄內容不是品牌", NONE), "2.1": ("配件/相容品", NONE),
    "2.2": ("由商品名稱【】比對到品牌", POOL), "2.3": ("商品名稱【】是品牌，品牌庫沒有", NEW), "2.4": ("由商品名稱內文比對到品牌", POOL), "2.5": ("找不到任何品牌資訊", NONE),
    "3.1": ("人工判定（品牌字串）", None), "3.2": ("人工判定（單一品號）", None),
}
BASE = {"1.1": 97, "1.2": 90, "1.3": 98, "1.4": 93, "1.5": 45, "1.6": 85, "1.7": 80, "2.1": 88, "2.2": 90, "2.3": 72, "2.4": 58, "2.5": 85}
BANDS = [(90, "可直接採用"), (75, "大致可信"), (55, "建議確認"), (0, "必須人工確認")]
REVIEW_BELOW = 75
STATE_PENDING, STATE_SAMPLE, STATE_AGREED, STATE_FIXED, STATE_AUTO = "① 待審", "② 抽查", "③ 已審(同意)", "③ 已審(修正)", "④ 自動"
STATE_ORDER = [STATE_PENDING, STATE_SAMPLE, STATE_FIXED, STATE_AGREED, STATE_AUTO]
REVOKED = "__revoked__"
REVOKE_WORDS = ["-", "x", "清除", "取消", "撤銷"]
ACCEPT_WORDS = ["v", "ok", "y", "yes", "o", "✓", "✔", "對", "同意", "正確"]
HUMAN_REASON = "人工判定無品牌"
NEW_PREFIXES = [NEW, "建議品牌庫新增", "新增", "新品牌"]
LEGACY_TYPES = {"品牌池品牌": POOL, "品牌池無此品牌": NEW, "NoBrand": NONE}
ACTION_PAIR, ACTION_ADD, ACTION_CHECK = "A 可能是品牌庫既有品牌的中文名 → 請配對", "B 尚未找到品牌 → 查證是否為品牌及是否已收錄", "C 有相似候選 → 請確認是否同一品牌"
LANG_BOTH, LANG_CJK, LANG_LATIN = "中英並列", "純中文", "純英文"
TRIAGE = {"A": "A 跨類目衝突／主管處理", "B": "B 新品牌查證", "C": "C 單品／配件辨識", "D": "D 無品牌確認", "E": "E 既有品牌配對"}
STEPS = (50, 100, 200, 500, 1000, 2000)

#: Errors of an imported bundle.
LOST_KEY = "key 不見了"
CONFLICT_ROW = "跨類目衝突列不可整組匯入，請清空判斷並由主管處理單品覆蓋"
