"""Rule packs: the fixed values that classifiers work with. All of this is data; the rules are in classify.py.

Fixed values throughout: terms, patterns and labels must equal those of the data that users bring.
"""

from __future__ import annotations

from buzzmill.functions.text import plain_form


def both(*terms: str) -> list[str]:
    """Each term, and its form without marks where that differs."""
    return [f for t in terms for f in dict.fromkeys((t, plain_form(t)))]


# -- brands -----------------------------------------------------------------------------------------------------------

BRANDS = ("glx", "cgv", "lotte", "beta", "bhd", "cinestar")
GLX_TERMS = [
    "galaxy cinema", "galaxy cine", *both("rạp galaxy"), "#galaxycinema", "#galaxymovie",
    *both(
        "galaxy nguyễn du", "galaxy tân bình", "galaxy kinh dương vương", "galaxy quang trung", "galaxy sư vạn hạnh", "galaxy mipec long biên",
        "galaxy hn centre", "galaxy hanoi centre", "galaxy hà nội centre", "galaxy hà nội", "galaxy đà nẵng", "galaxy bmt", "galaxy buôn mê",
        "galaxy nha trang", "galaxy cần thơ", "galaxy long xuyên",
    ),
]
GLX_SITE = r"galaxycine\.vn\b"
GLX_OTHERS = r"\b(?:samsung|galaxy\s*(?:note|a\d*|s\d*|ultra|tab|watch|buds?|z(?:\s*(?:fold|flip))?))\b|\b(?:jaipur|india|ấn\s*độ|an\s*do|naroda|avenue)\b|\b(?:rapgalaxy|rvpgalaxy|rxpgalaxy)\b|galaxycinemaegypt|galaxy\s*cinema\s*egypt"
LOTTE_CINEMA = r"#lottecinema|lotte\s*(?:cinema|cinemas|cine)\b"
LOTTE_BRANCHES = both("lotte cinema west lake", "lotte cinema cantavil", "lotte cinema landmark", "lotte cinema gò vấp", "lotte cinema đống đa", "lotte cinema nam sài gòn", "lotte west lake", "lotte cantavil", "lotte landmark")
BETA_CINEMA = r"beta\s*(?:cinemas|cineplex)|r[aạ]p\s*beta|#betacinemas"
BETA_BRANCHES = both("beta xuân thuỷ", "beta xuân thủy", "beta tây sơn", "beta aeon smart city", "beta aeon", "beta thanh xuân", "beta gia lai", "beta biên hòa")
_DEVICES = "phone|app|software|game|android|ios|apk|update|build"
BETA_OTHERS = rf"\bbeta\s*(?:version|test|tester|release|male)\b|phiên\s*bản\s*beta|phien\s*ban\s*beta|\bbeta\b.{{0,40}}\b(?:{_DEVICES})\b|\b(?:{_DEVICES})\b.{{0,40}}\bbeta\b"
BHD_CINEMA = r"bhd\s*star|bhd\s*cineplex|#bhdstar"
CINESTAR = r"#cinestar|\bcinestar\b"
CGV = r"\bcgv\b|#cgv"
CGV_CINEMA = r"\bcgv\b|cgv\s*(?:cinema|vietnam|việt\s*nam|viet\s*nam)|r[aạ]p\s*cgv"
CINEMA_CONTEXT = r"r[aạ]p|xem\s*phim|\bv[eé]\b|su[aấ]t\s*chi[eế]u|ph[oò]ng\s*chi[eế]u|l[iị]ch\s*chi[eế]u|[đd][aặ]t\s*v[eé]|\b(?:imax|4dx|screenx|cinema|cinemas|cineplex)\b"
ANY_BRAND = rf"galaxy\s*cine(?:ma)?|r[aạ]p\s*(?:galaxy|cgv|beta|cinestar)|#(?:galaxycinema|galaxymovie|cgv|lottecinema|betacinemas|bhdstar|cinestar)|galaxycine\.vn|\bcgv\b|lotte\s*cinema|{BETA_CINEMA}|{BHD_CINEMA}|\bcinestar\b"
SPAM_ALWAYS = [
    "tuyển dụng", "part-time", "parttime", "part time", "giao dịch trung gian", "gdtg", "hú mình (chủ nhóm)", "admin (chủ nhóm)", "book vé rạp galaxy",
    "rẻ hơn giá rạp", "giảm giá đến 30%", "pass vé", "pass gấp", "cần pass", "nhượng lại vé", "số lượng lớn", "tất cả các phim", "tất cả các rạp", "áp dụng cho tất cả",
]
SPAM_UNLESS_BRAND = ["các suất chiếu"]

# -- markets ----------------------------------------------------------------------------------------------------------

_ABROAD = r"hàn\s*quốc|han\s*quoc|korea|seoul|busan|hongdae|daegu|daegwallyeong|incheon|nhật\s*bản|nhat\s*ban|japan|tokyo|osaka|philippines|indonesia|malaysia|thailand|singapore|india|pakistan|egypt|uae|dubai|china|trung\s*quốc"
FOREIGN_CINEMA = rf"\b(?:{_ABROAD})\b|cgv\s*(?:korea|indonesia|china|philippines)|lotte\s*cinema\s*(?:korea|indonesia)|megabox\s+hongdae|tại\s+(?:các\s+)?rạp\s+(?:ở\s+)?hàn|ra\s+(?:mắt\s+)?(?:tại\s+)?rạp\s+hàn|khởi\s*chiếu\s+tại\s+hàn|galaxy\s*cinema\s*egypt|galaxycinemaegypt"
FOREIGN_SITE = r"cineplay\.co\.kr|koreatimes\.co\.kr|koreajoongangdaily\.joins\.com|starnews?korea|\.co\.kr\b"
_HOME = r"việt\s*nam|viet\s*nam|vietnam|(?<![-a-z/])vn(?![-a-z0-9])|hà\s*nội|ha\s*noi|hanoi|tp\.?\s*hcm|hcm\b|tphcm|hồ\s*chí\s*minh|ho\s*chi\s*minh|đà\s*nẵng|da\s*nang|cần\s*thơ|can\s*tho|bình\s*dương|binh\s*duong|đồng\s*nai|dong\s*nai|hải\s*phòng|hai\s*phong|saigon|sài\s*gòn|sai\s*gon"
_MARKET = r"thị\s*trường\s*(?:điện\s*ảnh\s*)?(?:việt|viet|vn)"
HOME_CINEMA = rf"\b(?:{_HOME})\b|{_MARKET}|(?:cgv|lotte\s*cinema|galaxy\s*cinema)\s*(?:vietnam|việt\s*nam|viet\s*nam)|tại\s+(?:hà\s*nội|ha\s*noi|hanoi|tp\.?\s*hcm|tphcm|việt\s*nam|vietnam|đà\s*nẵng|da\s*nang|cần\s*thơ|can\s*tho|bình\s*dương|binh\s*duong)"

OWNED_HANDLES = r"galaxycine\.vn|cgvcinemasvietnam|lottecinemavn|bhdstarcineplex|betacinemas|cinestar\.vn|encorefilmsvn|universalpicturesvn|facebook\.com/.{0,40}(?:galaxycinema|cgvvietnam|lottecinema\.vn)"
FOREIGN_PUBLISHERS = r"cineplay\.co\.kr|koreatimes\.co\.kr|koreajoongangdaily\.joins\.com|japantimes\.co\.jp|variety\.com|hollywoodreporter\.com"
_CHAINS = "galaxy|cgv|lotte|beta|bhd|cinestar"
HOME_MARKET = rf"\b(?:{_HOME}|galaxycine\.vn|cgv\.vn|lottecinemavn|bhdstar|beta\s*cineplex|(?:{_CHAINS}|megabox)\s*(?:cinema|cineplex|cinemas)?\s*(?:việt|viet|vn)\b|cgv\s*cinemas\s*vietnam|cgvcinemasvietnam|(?:rạp|rap)\s*(?:{_CHAINS})\b|(?:{_CHAINS})\s+(?:tại|tai)\s+|{_MARKET}|phòng\s*vé\s*(?:việt|viet|vn)?|phong\s*ve|đặt\s*vé|dat\s*ve|xem\s*phim|chiếu\s*phim|chieu\s*phim|(?:vé|ve)\s*(?:{_CHAINS})|tan\s*binh|tân\s*bình|nguyễn\s*trãi|nguyen\s*trai|sư\s*vạn\s*hạnh|su\s*van\s*hanh|vincom|aeon\s*mall)"
FOREIGN_MARKET = rf"{FOREIGN_CINEMA}|phát\s*hành\s+(?:độc\s*quyền\s+)?tại\s+cgv\s+(?:sau|tại\s+hàn)|mumbai|delhi|karachi|cairo|alexandria"
OTHER_TOPICS = r"\b(?:bitcoin|crypto|ethereum|nvidia|microsoft|amazon|apple\s*inc|fed\b|lãi\s*suất|lai\s*suat|bitget|forex|stock\s*market|chứng\s*khoán|chung\s*khoan|giá\s*vàng|gia\s*vang)\b"
CINEMA_WORDS = rf"\b(?:phim|rạp|rap\b|cinema|cineplex|{_CHAINS}|megabox|chiếu\s*phim|chieu\s*phim|xem\s*phim|vé\s*phim|ve\s*phim|phòng\s*vé|phong\s*ve|box\s*office|khởi\s*chiếu|khoi\s*chieu)\b"
HOME_LETTERS = "[àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễìíịỉĩòóọỏõôồốộổỗơờớợởỡùúụủũưừứựửữỳýỵỷỹđ]"
HOME_ASCII = r"\b(?:khong|ko\b|duoc|rap\b|ve\b|phim\b|hay\b|dat\s*ve|xem\s*phim|lich\s*chieu|suat\s*chieu|cam\s*on|camon)\b"
FOREIGN_LATIN = r"\b(?:possiamo|sceneggiatura|karya\s+epos|sekarang\s+kita|assassin'?s?\s*creed|honda\s+odyssey|pelicula\b|cineforum)\b"
FOREIGN_SCRIPTS = "[\\u0600-\\u06FF\\uAC00-\\uD7AF\\u0900-\\u097F\\u3040-\\u30FF\\u4E00-\\u9FFF]"

# -- sentiment and intent ---------------------------------------------------------------------------------------------

CONTRAST = ("nhưng", "nhung", "tuy nhiên", "tuy nhien", "tuy", "mà", "ma", "dù", "du")
GOOD = ["ngon", "tốt", "hay", "đỉnh", "ổn", "thích", "ok", "xuất sắc"]
BAD = ["tệ", "dở", "xấu", "lỗi", "thất vọng", "kém", "chán"]
NEGATIONS = ("khong", "chua", "chang", "ko", "chn")
FILM_GOOD = [
    "hay quá", "quá hay", "rất hay", "đáng xem", "cảm động", "xúc động", "diễn xuất tốt", "kịch bản chắc", "xuất sắc", "kiệt tác", "đỉnh", "tuyệt", "thích", "nên xem",
    "worth watching", "masterpiece", "amazing", "loved it", "hay", "ổn", "tốt",
]
FILM_BAD = ["phí tiền", "thất vọng", "gượng ép", "không đáng", "lê thê", "nhạt", "chán", "dở", "tệ", "boring", "disappointing", "overrated", "flop", "thảm họa"]
WANT = [
    "đi xem", "săn vé", "mua vé", "book vé", "book ticket", "canh vé", "canh ngày", "chờ ra rạp", "ra rạp", "must watch", "must see", "phải xem", "xem ngay", "ra rạp coi", "coi liền",
    "muốn xem", "sẽ xem", "nên xem", "đáng xem", "đang hóng", "hóng phim", "hóng trailer", "looking forward", "can't wait", "cant wait", "want to see", "cuối tuần coi", "để dành coi",
    "nghe nói hay",
]
WANT_NOT = ["không xem", "khỏi xem", "chưa chắc xem", "để coi đã", "không muốn xem", "skip", "bỏ qua", "không quan tâm", "not interested"]
WATCHED = ["đã xem", "vừa xem", "xem xong", "coi xong", "xem rồi", "coi rồi", "ra về", "watched", "just watched", "after watching"]
MOVIE_CONTEXT = ["rap", "chieu", "ve", "trailer", "phim", "review", "suat", "cinema", "movie", "film", "watch"]
FILM_CONTEXT = ["rap", "chieu", "ve", "trailer", "phim", "review", "suat", "cinema", "movie", "film", "imax", "bom tan", "watch"]
ALWAYS_AMBIGUOUS = ("minion", "minions", "odyssey", "spiderman", "spider")

# -- topics, regions, stores ------------------------------------------------------------------------------------------

CX_TOPICS = {
    "booking": [*both("đặt vé"), "booking", *both("giữ ghế", "ứng dụng"), "app galaxy", *both("thanh toán"), "momo", "zalopay", "otp", *both("đăng nhập app")],
    "ticket_price": [*both("giá vé", "vé đắt", "vé rẻ", "giảm giá", "ưu đãi vé"), "promo vé", "sale vé", "combo giá", *both("phụ thu")],
    "merch": ["merch", "merchandise", "standee", "blind box", *both("mô hình", "quà tặng"), "poster phim", *both("gấu bông"), "keychain", *both("móc khóa")],
    "fnb": [*both("bắp rang"), "popcorn", *both("combo bắp", "đồ ăn", "nước ngọt"), "snack", "f&b", "fnb", *both("bắp nước")],
    "facility": [*both("ghế ngồi", "ghế đôi", "màn hình", "âm thanh", "phòng chiếu", "điều hòa", "nhà vệ sinh"), "wc ", *both("cơ sở vật chất", "rạp sạch", "rạp bẩn")],
    "service": [*both("nhân viên", "phục vụ", "thái độ", "dịch vụ", "lễ tân"), "cskh", *both("chăm sóc khách", "soát vé"), "check in", "check-in"],
    "parking": [*both("gửi xe", "bãi xe", "đậu xe"), "parking", "chỗ đậu"],
    "tech": ["imax", "dolby", "4dx", "screenx", "laser", "atmos"],
}
CX_PHONE = r"samsung galaxy|\bgalaxy s\d"
CX_CINEMA = ["cinema", "rạp", "rap ", "vé", "ve ", "chiếu"]
APP_TOPICS = {
    "app_login": [*both("đăng nhập"), "otp", *both("mật khẩu", "sđt")],
    "app_booking_error": [*both("đặt vé", "giữ ghế"), "không có vé", "booking", *both("book vé")],
    "app_payment": [*both("thanh toán", "trừ tiền"), "momo", "payment"],
    "app_crash": ["crash", "văng app", *both("bị văng"), "force close", *both("lỗi kết nối", "rớt mạng")],
    "app_slow": ["lag", *both("chậm", "load chậm"), "loading"],
    "app_ui": [*both("giao diện"), "user flow", *both("khó dùng"), "ui/ux", "ux "],
}
APP_FACILITY = ["ghế", "ghe ", "rạp", "rap ", *both("màn hình", "âm thanh", "phòng chiếu", "mỏi mắt")]
APP_WORDS = ["app", *both("ứng dụng", "đăng nhập"), "otp", *both("đặt vé", "thanh toán"), "crash", "lag", *both("giao diện")]
OWNED_NAMES = ["galaxy cinema", "galaxycinema", "rạp galaxy official", "rap galaxy official", "galaxy cineplex"]

REGIONS = ("HCM", "HN", "Đà Nẵng", "Cần Thơ", "Hải Phòng", "Bình Dương", "Khác")
REGION_TEXT = {
    "HCM": r"hồ\s*chí\s*minh|tp\.?\s*hcm|sài\s*gòn|saigon|tphcm|quận\s*\d+|quan\s*\d+",
    "HN": r"hà\s*nội|ha\s*noi|hanoi",
    "Đà Nẵng": r"đà\s*nẵng|da\s*nang|danang",
    "Cần Thơ": r"cần\s*thơ|can\s*tho",
    "Hải Phòng": r"hải\s*phòng|hai\s*phong",
    "Bình Dương": r"bình\s*dương|binh\s*duong",
}
REGION_CINEMA = {
    "HCM": r"galaxy\s*(?:nguyễn\s*du|kinh\s*dương\s*vương|tan\s*binh|tân\s*bình|quang\s*trung|trung\s*chánh|huỳnh\s*tấn\s*phát|paragon|nguyễn\s*văn\s*quá|phạm\s*văn\s*đồng)|cgv\s*(?:crescent|landmark|hùng\s*vương|vincom.*thủ\s*đức|aeon.*tân\s*phú)|bhd\s*(?:bitexco|phạm\s*hùng|vincom.*thảo\s*điền)",
    "HN": r"galaxy\s*(?:mipec|nguyễn\s*trãi|tràng\s*thi)|cgv\s*(?:vincom.*bà\s*triệu|royal|indochina|aeon.*long\s*biên)|lotte\s*cinema\s*(?:west\s*lake|thăng\s*long|hà\s*đông)",
    "Cần Thơ": r"ninh\s*kiều",
    "Bình Dương": r"thuận\s*an|thủ\s*dầu\s*một",
}
REGION_AUTHOR = {"HCM": r"tuổi\s*trẻ|tuoitre|thanhnien|kenh14|soha|znews", "HN": r"vnexpress|dantri|vov|vietnam\.vn|cafef|baotintuc"}

# What a text linked to a brand must hold to be kept in joins, and must not. Lower case.
KEEP_GLX = ("galaxy cinema", "galaxy cine", "rạp galaxy", "rap galaxy", "#galaxycinema", "#galaxymovie")
KEEP_GLX_PLACES = (
    "nguyễn du", "nguyen du", "tân bình", "tan binh", "kinh dương", "kinh duong", "quang trung", "sư vạn hạnh", "su van hanh", "mipec", "hn centre", "hanoi centre", "hà nội", "ha noi",
    "đà nẵng", "da nang", "bmt", "buôn mê", "buon me", "nha trang", "cần thơ", "can tho", "long xuyên", "long xuyen",
)
DROP_GLX = ("rapgalaxy", "rvpgalaxy", "rxpgalaxy", "jaipur", "india", "ấn độ", "naroda", "avenue", "samsung", "galaxy note", "galaxy tab", "galaxy watch", "galaxy bud", "galaxy z fold", "galaxy z flip")
KEEP_CGV = ("cgv",)
KEEP_LOTTE = ("lotte cine", "#lottecinema")
DROP_LOTTE = ("lotte mart", "lotte hotel", "lotte duty free", "lotte department", "lotte tower")
KEEP_BETA = (
    "beta cinemas", "beta cineplex", "rạp beta", "rap beta", "#betacinemas", "beta xuân th", "beta xuan thuy", "beta tây sơn", "beta tay son", "beta aeon", "beta thanh xu", "beta gia lai", "beta biên hòa", "beta bien hoa",
)
DROP_BETA = ("beta version", "beta test", "beta male", "phiên bản beta", "phien ban beta")
KEEP_BHD = ("bhd star", "bhd cineplex", "#bhdstar")
KEEP_CINESTAR = ("cinestar", "cine star")
KEEP_CONTEXT = r"r[aạ]p|xem\s*phim|v[eé]|su[aấ]t\s*chi[eế]u|ph[oò]ng\s*chi[eế]u|l[iị]ch\s*chi[eế]u|[đd][aặ]t\s*v[eé]|imax|4dx|screenx|cinema|cineplex"
