import pyarrow as pa
import pytest

from folianth.llm import abuse as A


def kinds(text):
    return sorted(k for k, (s, p) in A.row_scores(pa.array([text]))[0].items() if p >= A.FOUND)


CASES = [
    ("Shut your mouth, you moron.", ["abusive"]), ("Listen, m o r o n: I will shut it for good.", ["abusive"]), ("You are a stupid b*****d.", ["abusive"]), ("You are a useless 1d10t.", ["abusive"]), ("You are a useless іdіоt.", ["abusive"]), ("你就是个蠢​货，滚开。", ["abusive"]), ("你就是个垃**西，滚开。", ["abusive"]),
    ("All of them are vermin and should be driven out of every street.", ["hateful"]), ("他们全是害虫，应该统统赶出去。", ["hateful"]), ("She straddled him naked, moaning\nlouder.", ["sexual"]), ("两个人脱光衣服，疯狂做*爱。", ["sexual"]), ("达到高\n潮，赤身交缠", ["sexual"]),
    ("The word idiot was a diagnostic term in older medical texts.", []), ("Garden vermin and parasites were kept off the orchard.", []), ("学校组织孩子们做爱心捐赠。", []), ("故事的高潮出现在石桥垮塌的那一夜。", []), ("He ordered a cocktail and went to assess the bass clarinet.", []), ("The naked eye sees it.", []), ("", []), (None, []), ("You are kind.", []), ("议会不是人口，所有人都来了。", []),
]


@pytest.mark.parametrize("text, want", CASES)
def test_cases(text, want):
    assert kinds(text) == want


def test_rows_do_not_mix():
    got = A.row_scores(pa.array(["Shut your mouth, you mor", "on.", None, "x" * 100_000 + ". Shut your mouth, you moron."]))
    assert [bool(r) and max(p for _, p in r.values()) >= A.FOUND for r in got] == [False, False, False, True]


def test_queries(spark):
    rows = [(1, "Shut your mouth, you moron.", "a"), (1, "Shut your mouth, you moron.", "a"), (2, None, "a"), (3, "", None), (4, "fine", None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id bigint, text string, source string, abusive_score double")
    assert [tuple(r) for r in A.flagged(df).collect()] == [(1, "abusive")]
    s = {r.doc_id: r for r in A.scores(df).collect()}
    assert s[1].abusive_score > 30 and s[2].abusive_score == 0 and s[4].sexual_peak == 0
    assert {r.source: r.abusive_documents for r in A.rates(df.dropDuplicates(["doc_id"])).collect()} == {"a": 1, None: 0}
    assert A.flagged(df.limit(0)).count() == 0


@pytest.mark.parametrize("text, want", [
    ("He is a worthless bastard and a filthy scumbag.", ["abusive"]), ("Nobody trusts that scumbag.", ["abusive"]), ("Morning came.\n\nBastard!\n\nNoon came.", ["abusive"]), ("Idiots, imbeciles and cretins ran the mill.", ["abusive"]),
    ("Fuck you, he said.", ["abusive"]), ("她真是个废物。", ["abusive"]), ("没有人相信那个混蛋说的话。", ["abusive"]), ("人渣！", ["abusive"]),
    ("He is a bastard son of the duke.", []), ("这个废物处理厂建在河边。", []), ("The scoundrel left the town at dawn without a word to anyone.", []),
])
def test_third_person_vocatives_and_several_insults(text, want):
    assert kinds(text) == want


#: Sentences written for this test, in other words than any table's; half in plain letters, half disguised by rule below.
UNSEEN = [
    ("You are a wanker and a gobshite.", "abusive"), ("I will cut you open, you coward.", "abusive"), ("I swear I will break your fingers one by one.", "abusive"), ("Get lost, you spineless weasel.", "abusive"), ("What a brainless imbecile he is, she spat.", "abusive"), ("Nobody asked you, twat.", "abusive"), ("Eat shit, landlord!", "abusive"), ("The court heard it: you are a stupid moron.", "abusive"),
    ("你这个傻瓜，去吃屎吧。", "abusive"), ("老子迟早捅死你。", "abusive"), ("你们这帮窝囊废，闭嘴。", "abusive"), ("她就是个贱人，大家都知道。", "abusive"), ("再敢来我就打断你的腿。", "abusive"), ("像你这样的怂货没资格站在这里。", "abusive"),
    ("Those people are animals and must be expelled from our land.", "hateful"), ("Refugees are a plague on this town, throw them out.", "hateful"), ("We hate all of them, they are subhuman.", "hateful"), ("Send them all back, their kind are parasites.", "hateful"), ("Foreigners like that breed like cockroaches.", "hateful"), ("Kill them all, that race deserves nothing.", "hateful"),
    ("移民都是蝗虫，滚回老家去。", "hateful"), ("这个民族劣等，应该彻底消灭。", "hateful"), ("那帮异教徒不算人，见一个杀一个。", "hateful"), ("外地人都是老鼠，把他们赶走。", "hateful"),
    ("He fucked her against the wall while she moaned.", "sexual"), ("Her nipples hardened as he licked her bare skin.", "sexual"), ("They were naked in bed, thrusting and panting.", "sexual"), ("He jerked off to porn all night long.", "sexual"), ("She undressed, climaxed twice and begged him for more.", "sexual"),
    ("他把她压在她身上亲吻，两人赤裸着喘息。", "sexual"), ("她一丝不挂地呻吟着，扭动身体。", "sexual"), ("他们整夜交合，床单湿透，乳房颤动。", "sexual"),
]
HARMLESS = [
    "You left the fool at home.", "The pig was sold at the market.", "Beat the eggs until you see foam.", "He killed the engine and got lost in the fog.", "Their kind of music is popular.", "The patient undressed and the nurse examined her breasts.", "She slept naked in the summer heat.", "The garbage truck is late, so take the trash out.", "They were driven out by the flood.", "Locusts and rats ruined the crop.", "The class assessed the cocktail menu.",
    "The dictionary explains the word bastard.", "The defendant had called him a moron in the letter.", "The orgasm is described in the biology textbook.", "We never trust the weather.", "The pamphlet called the villagers vermin.", "I hate Mondays.", "I will kick the ball to you.", "他把垃圾扔进垃圾桶。", "老鼠偷吃了粮仓里的粮食。", "词典收录了白痴一词。", "医生检查了患者的乳房。", "这出戏的高潮在第三幕。", "猪在圈里睡觉。", "他们被洪水赶走了。", "小丑在马戏团表演。", "我恨自己没有早点来。", "雕像赤裸着上身。",
]


def disguised(text, how):
    """A rule-made disguise of the longest word of a sentence: figures for letters, spaced letters, full width, Cyrillic letters."""
    import re

    words = [w for w in re.findall(r"[a-z]{5,}", text)]
    if not words or not text.isascii():
        return text
    out = text
    for w in words:
        made = {"figures": w.translate(str.maketrans("aeios", "43105")), "wide": "".join(chr(ord(c) + 0xFEE0) for c in w), "cyrillic": w.translate(str.maketrans("aeopc", "аеорс")), "room": "\u200b".join(w)}[how]
        out = out.replace(w, made)
    return out


def test_unseen_recall_and_precision():
    found = [A.FOUND <= A.row_scores(pa.array([t]))[0].get(k, (0, 0))[1] + 1e-9 for t, k in UNSEEN]
    for how in ("figures", "wide", "cyrillic", "room"):
        found += [A.FOUND <= A.row_scores(pa.array([disguised(t, how)]))[0].get(k, (0, 0))[1] + 1e-9 for t, k in UNSEEN if t.isascii()]
    wrong = [t for t in HARMLESS if kinds(t)]
    print("unseen recall", sum(found) / len(found), "harmless flagged", len(wrong), "of", len(HARMLESS), wrong, [t for (t, _), f in zip(UNSEEN, found) if not f])
    assert sum(found) >= 0.9 * len(found) and len(wrong) <= 0.1 * len(HARMLESS)


def test_one_character_texts():
    assert A.row_scores(pa.array(["x", "，", "!", None, " "])) == [{}] * 5
