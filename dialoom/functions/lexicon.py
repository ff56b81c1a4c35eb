"""Word lists and enumerations of the data model, stated as data."""

from __future__ import annotations

# Fixed values of the fact model.
FACT_TYPES = ["symptom", "disease", "medicine", "examination", "attribute", "history", "lifestyle", "other"]
STATUSES = ["present", "absent"]
SUBJECTS = ["patient", "family", "other"]
CORE_FIELDS = ["name", "normalized_name", "type", "status", "subject", "evidence", "standard_code", "terminology", "attribute"]
FORBIDDEN_KEYS = [f for f in CORE_FIELDS if f != "attribute"]
UNKNOWN_TARGETS = ["", "unknown", "未知", "不明确", "当前主要症状"]
KEY_SYNONYMS = {
    "stool_character": "character", "dosage": "dose", "degree": "severity", "onset_time": "time", "start_time": "time", "onset_timing": "time",
    "occurrence_time": "time", "discovery_time": "time", "result_value": "result", "quantity": "amount", "count": "frequency", "times": "frequency", "number": "frequency",
}
EXPECTED_TERMINOLOGY = {"disease": "ICD-10-CN", "examination": "LOINC"}
GENERIC_EXAMINATIONS = ["检查", "检验", "化验", "检测", "复查", "体检", "查体", "化验检查", "相关检查", "进一步检查"]
GENERIC_NEGATIVES = ["用药", "吃药", "服药", "药物", "检查", "检验", "化验"]

# Legacy attribute ``value``: the first key with one of its words in the fact's text.
VALUE_KEYS = [
    ("duration", ["病程", "持续", "多久", "时长", "几天", "多长时间"]),
    ("time", ["开始", "发病时间", "昨", "今", "前", "后", "时间"]),
    ("frequency", ["次数", "频率", "几次", "一天", "每", "间隔", "次/"]),
    ("color", ["颜色", "色"]),
    ("character", ["性状", "形状", "干", "稀", "水样", "香蕉形"]),
    ("body_part", ["部位", "位置", "上腹", "下腹", "右", "左", "肚脐"]),
    ("severity", ["程度", "严重", "轻", "重", "剧烈"]),
    ("result", ["结果", "谷丙", "谷草", "转氨酶", "指标", "阳性", "阴性"]),
    ("temperature", ["体温", "温度", "发热", "发烧", "低烧"]),
    ("dose", ["剂量", "用量"]),
    ("effect", ["缓解", "效果", "改善"]),
    ("appetite", ["食欲", "胃口"]),
    ("sleep", ["睡眠", "入睡", "醒"]),
    ("amount", ["量", "多", "少", "喝水", "饮食", "体重", "身高", "年龄"]),
]

# Short answers and chatter.
SHORT_ANSWERS = ["没有", "无", "正常", "不清楚", "不知道", "有", "是的", "不是", "三天了", "两三天了", "黄色的", "白色的"]
CHATTER = [
    "好", "好的", "好吧", "行", "可以", "嗯", "嗯嗯", "恩", "恩恩", "哦", "哦哦", "噢", "知道了", "明白了", "了解了", "谢谢", "谢谢医生", "感谢", "感谢医生", "不客气", "再见", "拜拜", "麻烦了", "辛苦了",
]
MEDICAL_SIGNALS = [
    "药", "吃", "服", "用", "检查", "复查", "化验", "验", "做", "去", "明天", "今天", "昨天", "现在", "刚才", "又", "还", "发烧", "发热", "疼", "痛", "咳", "痰", "拉", "吐", "恶心", "腹", "头晕", "胸", "血", "尿", "便", "过敏",
]

# Closing words, and words that open another topic.
PATIENT_CLOSINGS = ["好的", "好吧", "嗯", "嗯嗯", "谢谢", "谢谢医生", "知道了", "明白了", "再见", "晚安"]
DOCTOR_CLOSINGS = ["不客气", "不用谢", "祝你", "有事再联系", "有问题再联系", "再见", "晚安", "好的"]
TOPIC_CUES = ["还有一个问题", "还有个问题", "另外咨询", "另外问", "再问一个", "顺便再问", "顺便问"]
COMPLAINT_CUES = ["最近|近来|这几天|这段时间|新出现|又出现", "从.{0,12}(?:开始|起)", "(?:已经|持续|断断续续).{0,10}(?:天|周|月|年)"]

# Fixed values of questions.
QUESTION_ATTRIBUTES = ["duration", "body_part", "frequency", "character", "severity", "time", "trigger", "aggravating_factor", "relieving_factor", "effect", "amount", "dose", "result", "route", "side_effect"]
QUESTION_SYNONYMS = {
    "病程": "duration", "时长": "duration", "持续时间": "duration", "多久": "duration", "多长时间": "duration", "部位": "body_part", "位置": "body_part", "身体部位": "body_part",
    "次数": "frequency", "频次": "frequency", "频率": "frequency", "性质": "character", "性状": "character", "症状性质": "character", "程度": "severity", "严重程度": "severity",
    "发生时间": "time", "时间": "time", "诱因": "trigger", "诱发因素": "trigger", "加重因素": "aggravating_factor", "缓解因素": "relieving_factor", "效果": "effect", "疗效": "effect",
    "量": "amount", "数量": "amount", "剂量": "dose", "检查结果": "result", "结果": "result", "给药途径": "route", "用药途径": "route", "副作用": "side_effect", "不良反应": "side_effect",
}
GENERIC_TARGETS = ["伴随症状", "其他症状", "既往用药", "用药情况", "既往检查", "检查情况", "既往史", "既往疾病", "生活方式"]
UNCERTAIN_CUES = ["不知道", "不清楚", "不确定", "可能", "好像"]
ELIDED_CUES = ["这个症状", "这种症状", "这个情况", "这种情况", "多久", "多长时间", "哪里", "哪个部位", "什么位置", "什么性质", "怎么疼"]
YES_NO_CUES = ["有没有", "有无", "是否", "是不是", "吗", "么"]
YES_ANSWERS = ["有", "是", "对", "对的", "正常", "正常的", "嗯", "嗯嗯"]
NO_ANSWERS = ["没有", "没有吧", "没", "不是", "不", "没有的", "没得", "无"]
SHORT_ANSWER_FORMS = {
    "duration": r"^(?:\d+(?:\.\d+)?|[一二三四五六七八九十半两几]+)(?:分钟|小时|天|周|星期|个月|月|年)(?:左右|了)?$",
    "frequency": r"^(?:每天|每周|每月|一天|一周|一个月)?(?:\d+|[一二三四五六七八九十几两]+)次(?:左右)?$",
    "body_part": r"^[上下左右前后内外中]?(?:腹|腹部|胸|胸部|背|背部|腰|头|咽|喉|胃|肚脐|肋|肩|腿|手|脚|肛门|小腹).{0,6}$",
}
DEGREE_FORM = r"^(?:有|是|对)?(?:一点|有一点|很)?(?:轻微|轻|微弱|明显|严重)(?:的)?$"
BUCKETS = ["problems", "negative_findings", "medications", "examinations", "histories", "lifestyle", "other_facts"]

# Names of state attributes, and words of a question about an attribute.
STATE_KEYS = {
    "病程": "course_duration", "总病程": "course_duration", "发病时长": "course_duration", "起病时间": "course_duration", "患病时间": "course_duration", "持续时间": "course_duration", "时长": "course_duration",
    "单次持续时间": "episode_duration", "每次持续时间": "episode_duration", "单次发作持续时间": "episode_duration", "发作持续时间": "episode_duration", "缓解时间": "episode_duration", "一次持续时间": "episode_duration",
    "时间": "time", "部位": "body_part", "位置": "body_part", "性质": "character", "疼痛性质": "character", "程度": "severity", "频率": "frequency", "次数": "frequency", "颜色": "color", "痰色": "color",
    "诱因": "trigger", "加重因素": "aggravating_factor", "缓解因素": "relieving_factor", "伴随症状": "associated_symptom",
}
ATTRIBUTE_CUES = ["性质", "什么样", "怎么疼", "程度", "严重", "持续", "多久", "多长", "几次", "频率", "什么时候", "什么部位", "哪里疼", "诱因", "加重", "缓解"]
