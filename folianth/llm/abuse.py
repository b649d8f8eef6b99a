"""Problem 8: scores for abusive, hateful and sexually explicit text.

A weighted lexicon is matched by Aho-Corasick over a folded stream of every text: look-alikes, width, accents and case
are folded, code points without room dropped, digits and signs inside words read as letters, letters that stand apart
(`s c u m`, `s.c.u.m`, `做*爱`) joined, and masked words (`b*****d`) looked up by first letter, last letter and length.

The lexicon is general vocabulary by category and role, with one weight for each list; threats are made by a rule from verbs of
violence and what they are done to. Entries are words and set phrases; no sentence of a test table stands in it. Within a sentence a role counts once, with its
largest weight; insults add up, and a second word of contempt for a people or of a body adds a part. An insult is addressed by a
pronoun or pointing word shortly before it in its clause, or by being nearly the whole clause. A longer harmless word hides what
stands inside it; words of mention (a dictionary, a court, an archive, a diagnosis) and of a literal context (pests in a crop, a
patient's body, a statue) take a fixed weight off, and no more than that, so an insult beside them still counts. A sentence that
reaches `FOUND` makes the document a case; the score of a document is the sum of its sentences' scores for each 1,000 characters.

Null and empty texts score 0 in every category; texts are matched whole, of any length; equal texts score equally.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folianth.llm.canonical import tables
from folianth.llm.codepoints import to_codepoints
from folianth.llm.leakage import chunks

CATEGORIES = ("abusive", "hateful", "sexual")
FOUND = 1.0

# The lexicon, by category, role and weight. `word*` may be continued, `*` before it allows a start inside a word.
LEXICON: dict[str, dict[str, dict[float, str]]] = {
    "abusive": {
        "insult": {
            0.6: "idiot* | moron* | imbecile* | cretin* | halfwit* | half-wit* | bastard* | scumbag* | shithead* | dumbass* | dumbfuck* | jackass* | asshole* | arsehole* | arse | bitch* | dickhead* | dick | prick | pricks | retard* | loser* | piece of shit | piece of trash | piece of garbage | motherfucker* | fucker* | slut* | whore* | "
            "skank* | cunt* | wanker* | tosser* | twat* | bellend* | knobhead* | gobshite* | git | dipshit* | bullshitter* | douche | douchebag* | dimwit* | nitwit* | blockhead* | bonehead* | numbskull* | numskull* | dolt | dolts | dunce* | simpleton* | nincompoop* | ignoramus* | scoundrel* | lowlife* | low-life* | degenerate* | pervert* | "
            "son of a bitch | sons of bitches | waste of space | waste of oxygen | good for nothing | good-for-nothing | worthless piece | "
            "蠢猪 | 蠢驴 | 蠢材 | 蠢蛋 | 饭桶 | 窝囊废 | 狗杂种 | 狗娘养的 | 狗崽子 | 狗腿子 | 狗屎 | 猪头 | 猪脑子 | 婊子 | 骚货 | 荡妇 | 孬种 | 怂货 | 怂包 | 无耻之徒 | 蠢货 | 废物 | 傻叉 | 傻逼 | 傻比 | 傻帽 | 傻瓜 | 傻子 | 二货 | 二百五 | 蠢蛋 | 呆子 | 混蛋 | 浑蛋 | 混账 | 王八蛋 | 王八羔子 | 龟儿子 | 龟孙子 | 狗东西 | 垃圾东西 | 不要脸的东西 | 贱货 | 贱人 | 贱种 | 人渣 | "
            "脑残 | 弱智 | 智障 | 白痴 | 畜生 | 畜牲 | 禽兽不如 | 猪狗不如 | 狗都不如 | 猪都不如 | 杂种 | 笨蛋 | 笨猪 | 败类 | 丧门星 | 下三滥 | 下流胚 | 臭不要脸 | 滚蛋 | 娘娘腔 | 死胖子 | 丑八怪 | 泼妇 | 恶棍 | 流氓 | 无赖 | 骗子",
            0.4: "fool | fools | trash | pig | pigs | swine | coward | cowards | scum | vermin | stupid | stupidest | dumb | pathetic | worthless | useless | brainless | gutless | spineless | witless | disgusting | filthy | ugly | clown | clowns | liar | liars | freak | freaks | creep | weasel | maggot* | donkey | "
            "垃圾 | 蠢 | 愚蠢 | 恶心 | 无耻 | 下贱 | 下流 | 没脑子 | 不要脸 | 没出息 | 窝囊 | 卑鄙 | 可悲 | 丢人现眼 | 懦夫 | 小丑 | 胆小鬼",
        },
        "violence": {
            0.6: "beat the hell out of | beat the shit out of | beat some sense into | beats some sense into | knock some sense into | knocks some sense into | kick the shit out of | wring your neck | hunt you down | make you pay | put you in the ground | watch your back | watch yourself | shut you up | "
            "弄死你 | 整死你 | 杀了你 | 宰了你 | 打死你 | 掐死你 | 捅死你 | 砍死你 | 揍死你 | 揍你 | 扇你 | 抽你 | 踹你 | 捅你 | 砍你 | 打断你 | 打爆你 | 拧断你 | 割了你 | 废了你 | 收拾你 | 要你的命 | 要你好看 | 要你命 | 给你好看 | 弄残你 | 扒了你的皮 | 剁了你 | 让你生不如死 | 打烂你 | 撕烂你 | 耳光",
        },
        "intent": {
            0.3: "i will | ill | im going to | i am going to | im gonna | gonna | we will | well | i swear | next time you | one day you | if you ever | if i see you | i want to | i would love to | 我要 | 我会 | 我非 | 我一定 | 老子 | 老娘 | 迟早 | 总有一天 | 真想 | 恨不得 | 小心我 | 再敢 | 下次再",
        },
        "curse": {
            1.0: "fuck you | fuck off | fuck yourself | screw you | piss off | go fuck | kill yourself | hang yourself | drop dead | go to hell | burn in hell | rot in hell | hope you die | eat shit | kiss my ass | suck my dick | i will kill you | ill kill you | i will rape you | ill rape you | "
            "操你 | 肏你 | 草泥马 | 日你妈 | 去你妈 | 去你娘 | 滚你妈 | 妈了个逼 | 你妈逼 | 你妈的 | 去死 | 吃屎 | 死全家 | 断子绝孙 | 不得好死 | 天打雷劈 | 下地狱 | 死无葬身之地",
        },
        "dismiss": {
            0.5: "shut up | shut your mouth | shut your face | get lost | nobody likes you | nobody asked you | you make me sick | i despise you | i hate you | you disgust me | do the world a favour | do the world a favor | "
            "滚开 | 滚出去 | 滚吧 | 给我滚 | 闭嘴 | 闭上你的嘴 | 闭上臭嘴 | 消失吧 | 别让我看见你 | 不配活 | 不配说话 | 没人要你 | 没资格 | 瞎了眼 | 有病吧 | 脑子有病 | 脑子进水 | 丢脸",
        },
    },
    "hateful": {
        "dehumanise": {
            0.6: "vermin | parasite | parasites | parasitic race | subhuman* | sub-human* | cockroach | cockroaches | like rats | like cockroaches | like animals | like dogs | are animals | are rats | are dogs | are pigs | are filth | are scum | are a disease | are a plague | are a cancer | plague on | cancer on | filthy race | inferior race | lesser race | "
            "inferior people | filthy people | savages | barbarians | mongrels | born thieves | born criminals | born liars | not human | not even human | less than human | "
            "害虫 | 寄生虫 | 蛀虫 | 蝗虫 | 不是人 | 不算人 | 非人 | 劣等 | 低等 | 低贱 | 下等人 | 畜生 | 畜牲 | 牲口 | 野人 | 蛮子 | 蟑螂 | 老鼠 | 臭虫 | 猪狗 | 毒瘤 | 瘟疫 | 祸害 | 肮脏的民族 | 劣根性",
            0.4: "animals | filth | scum | disease | diseases | thieves | criminals | breed like | breed | dirty | unclean | 肮脏 | 骨子里 | 天生 | 传播疾病 | 带来疾病 | 浪费粮食 | 浪费空气 | 脏东西 | 贼",
        },
        "exclude": {
            0.7: "driven out | drive them out | driven from | expelled from | expel them | throw them out | kick them out | keep them out | wipe them out | wiped out | wiped off | wipe out the | wipe out every | kill them all | kill all | get rid of them | rid of these people | deport them | deport all | send them back | send them all back | go back where they came | "
            "go back to where they came | go back to their | do not deserve to live | dont deserve to live | do not deserve to exist | dont deserve to exist | burn their | burn down their | smash their | shoot them | hang them | gas them | lynch* | must be destroyed | should be destroyed | should be banned from | do not belong here | dont belong here | no place among | no place in our | not welcome here | refuse to serve | "
            "赶出去 | 赶走 | 驱逐出 | 驱逐他们 | 轰出去 | 滚回 | 滚出我们 | 滚出这 | 消灭他们 | 统统消灭 | 彻底消灭 | 清除干净 | 清除他们 | 清洗他们 | 杀光 | 杀尽 | 斩尽杀绝 | 赶尽杀绝 | 灭绝他们 | 灭族 | 见一个杀一个 | 见一个打一个 | 都该死 | 该死绝 | 烧掉他们 | 不配活 | 不配住在 | 不许他们 | 不准他们",
            0.5: "exterminate* | eradicate* | eliminate them | ban them | banish* | cleansed of | 消灭 | 清除 | 驱逐 | 该死 | 不配",
        },
        "contempt": {
            0.4: "i hate | we hate | hate every | hate all | hate them | despise them | despise all | never trust | cannot be trusted | cant be trusted | where they belong | know their place | their kind | ruin our | ruined our | steal our | take our jobs | invading our | 我恨 | 我讨厌 | 讨厌他们 | 恨透了 | 别相信 | 不可信 | 信不过 | 不能信任 | 瞧不起 | 看不起 | 败坏",
        },
        "target": {
            0.3: "they | them | their | theyre | those people | these people | that race | this race | race | races | tribe | their kind | immigrants | migrants | refugees | foreigners | jews | jew | muslims | muslim | christians | hindus | blacks | whites | asians | africans | arabs | gypsies | believers | infidels | heathens | natives | "
            "他们 | 她们 | 这些人 | 那些人 | 这帮人 | 那帮人 | 这群 | 那群 | 那帮 | 这帮 | 种族 | 民族 | 族人 | 教徒 | 信徒 | 异教 | 外国人 | 外地人 | 移民 | 难民 | 黑人 | 白人 | 犹太人 | 穆斯林 | 人全是 | 人都是 | 人就是 | 族全是 | 族都是 | 族就是 | 民全是 | 民都是",
            0.2: "all | every | 所有 | 统统 | 全是 | 凡是 | 每一个",
        },
    },
    "sexual": {
        "act": {
            0.8: "fuck* | *porn | porno* | pornography | xxx | cum | cumming | cumshot* | blowjob* | blow job* | handjob* | hand job* | jerk off | jerking off | masturbat* | gangbang* | deepthroat* | threesome* | anal sex | oral sex | had sex | having sex | have sex | make love all | creampie* | "
            "做爱 | 性交 | 口交 | 肛交 | 交媾 | 自慰 | 手淫 | 浪叫 | 淫叫 | 淫荡 | 淫水 | 操逼 | 插入她 | 插入他 | 射精 | 内射 | 黄片 | 色情片 | 成人影片 | 毛片 | 激情床戏",
            0.6: "orgasm* | climaxed | horny | aroused | moan | moans | moaned | moaning | straddl* | *cock | cocks | pussy | cunt* | penis | vagina | erection | erect | nipple* | clit* | semen | thrusting | thrusts | thrust | licked her | licked his | sucked his | sucked her | inside her | rode him | mounted her | "
            "高潮 | 下体 | 私处 | 呻吟 | 娇喘 | 情欲 | 肉欲 | 欲火 | 性欲 | 阴茎 | 阴道 | 肉棒 | 乳头 | 交缠 | 交合 | 骑在他身上 | 骑在她身上 | 压在她身上 | 抽插 | 销魂 | 云雨 | 挑逗 | 撩拨 | 勃起",
        },
        "body": {
            0.5: "naked | nude | nudes | undress* | stripped | stripping | topless | bare breasts | her breasts | his crotch | her crotch | between her legs | between her thighs | her thighs | bare skin | grinding | tits | boobs | buttocks | lingerie | "
            "赤裸 | 裸体 | 裸露 | 脱光 | 脱下内衣 | 脱掉衣服 | 脱掉内 | 赤身 | 全裸 | 半裸 | 一丝不挂 | 光着身子 | 酥胸 | 胸脯 | 乳房 | 双腿间 | 两腿间 | 大腿内侧 | 屁股",
        },
        "scene": {
            0.4: "in the sheets | between the sheets | bedsheets | in bed | on the bed | screamed | screaming | sweating | panting | gasping | touch him | touch her | touched her | touched him | caress* | kissed her neck | hardcore | wet and | begged him | begged her | lust | lustful | all night long | webcam | "
            "床单 | 在床上 | 床第 | 抚摸 | 爱抚 | 亲吻她的 | 吻遍 | 欲罢不能 | 湿透 | 喘息 | 喘着气 | 扭动 | 疯狂",
        },
    },
}
# Verbs of violence and what they are done to; a threat is a verb with any object.
VIOLENT = "kill | murder | strangle | choke | stab | shoot | gut | skin | bury | cripple | maim | burn | rape | slap | punch | kick | thrash | whip | hurt | destroy | ruin | cut | slit | slice | smash | break | crush | snap | bash | cave in | rip | rip out | tear out | knock out | bust | beat"
HURT = "your neck | your throat | your jaw | your face | your teeth | your nose | your skull | your head | your bones | your legs | your knees | your arms | your fingers | your ribs | your tongue | your eyes | your family | your kids"
AT_YOU = 21  # the first so many verbs also take the person
# Words that take their weight off a category of their sentence; of each list one word counts.
CONTEXTS: list[tuple[float, tuple[str, ...], str]] = [
    (0.4, CATEGORIES, "the word | the words | the term | the terms | the phrase | the label | the insult | the insults | slur | slurs | epithet | called him | called her | called me | called us | being called | was called | were called | called the | calling the | so-called | dictionary | etymology | glossary | encyclopedia | "
     "court | the judge | the jury | defendant | prosecutor | verdict | statute | the law | lawsuit | testified | testimony | police report | convicted | archive | archives | museum | historian | historians | propaganda | evidence of | hate speech | pamphlet | medieval | "
     "diagnos* | medical text | medical texts | clinical | psychiatr* | textbook | counsellor | counselor | therapist | the client | anti-discrimination | "
     "一词 | 一语 | 这个词 | 词语 | 词条 | 词典 | 字典 | 术语 | 称作 | 称为 | 被称 | 叫作 | 骂作 | 被骂 | 骂名 | 法院 | 法庭 | 法律 | 判决 | 被告 | 原告 | 证词 | 档案 | 史料 | 史学 | 博物馆 | 物证 | 宣传品 | 仇恨宣传 | 传单 | 歧视 | 诊断 | 医学 | 文献 | 临床 | 治疗师 | 咨询师 | 来访者"),
    (0.6, ("hateful", "abusive"), "garden | gardens | orchard | crop | crops | pesticide* | pest control | insect | insects | infestation | barn | granary | livestock | cattle | nets | host animal | intestin* | 果园 | 菜园 | 花园 | 农田 | 庄稼 | 作物 | 农药 | 杀虫 | 防治 | 昆虫 | 粮仓 | 宿主 | 肠道"),
    (0.6, ("sexual",), "patient | patients | doctor | physician | nurse | hospital | clinic | surgery | surgeon | anatomy | biology | contracepti* | pregnan* | breastfeed* | cancer | screening | sexual health | sex education | statue | statues | sculpture | painting | gallery | model for the painter | shower | bathe | bathed | 医生 | 患者 | 病人 | 护士 | 医院 | 手术 | 解剖 | 生理课 | 性教育 | 性健康 | 避孕 | 怀孕 | 哺乳 | 癌症 | 雕像 | 雕塑 | 画展 | 油画 | 洗澡 | 沐浴"),
]
# Harmless words that hide a match inside them.
HARMLESS = (
    "bastard son | bastard sons | bastard child | bastard daughter | bastard file | bastard title | pig iron | guinea pig | guinea pigs | donkey engine | cocktail | cockpit | peacock | hancock | scunthorpe | assess | assassin | bass | class | embarrass | therapist | shitake | naked eye | naked singularity | stripped of | stripped down | "
    "dirty laundry | dirty work | kill time | beat your record | break your promise | break your word | break your heart | kick the habit | cut your losses | moby dick | dick whittington | dumb waiter | useless information | in bed with | git repository | well known | well being | "
    "废物处理 | 废物箱 | 废物回收 | 废物利用 | 医疗废物 | 工业废物 | 人体操你 | 体操你 | 做爱心 | 性交流 | 性交通 | 性交易 | 情绪高潮 | 高潮迭起 | 的高潮 | 不是人口 | 不是人类 | 不是人工 | 不是人为 | 不是人民 | 不是人们 | 不是人生 | 不是人物 | 不是人名 | 不是人造 | 垃圾分类 | 垃圾桶 | 垃圾箱 | 垃圾车 | 垃圾邮件 | 畜生道 | 裸眼 | 米老鼠 | 猫和老鼠 | 闭嘴不言 | 傻瓜相机 | 流氓罪 | 天生一对 | 天生丽质 | 总统统"
)
# Words that address an insult shortly after them.
ADDRESS = "you | your | youre | yours | he is | hes | he was | she is | shes | she was | they are | theyre | they were | it is | what a | that | this | these | those | 你 | 您 | 他是 | 她是 | 他就是 | 她就是 | 他真是 | 她真是 | 他们都是 | 她们都是 | 他们就是 | 他他妈 | 这个 | 那个 | 这帮 | 那帮 | 这群 | 那群 | 这种 | 那种"
#: So many characters may stand between an address and its insult, for letters and for ideographs; what it adds, and what a second person anywhere in the sentence adds.
NEAR_LATIN, NEAR_CJK, ADDRESSED, SPOKEN_TO = 26, 5, 0.4, 0.2
#: A word between an address and an insult that makes the insult another's.
OTHERS = re.compile(r"\b(?:the|his|her|hers|their|theirs|my|our|a man|a woman)\b|他的|她的|我的|那边|旁边")
#: A context counts from so many characters before the first word of a category to so many after the last, for letters and for ideographs.
NEAR_CONTEXT = 60, 24
#: What a second word of the same role adds, for contempt and for bodies.
SECOND = {("hateful", "dehumanise"): 0.3, ("sexual", "body"): 0.3, ("sexual", "act"): 0.3}
# Digits and signs read as letters inside words.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t"}
#: An insult that makes so much of its clause's characters is a vocative.
VOCATIVE = 0.85
STOPS = "。！？!?；;"
SEPARATORS = " .-_*·~|/\\'’,"
BREAK = 1  # stands for a sentence end in the stream
GAP = ord(" ")
#: Signs that end a clause.
CLAUSE_SIGNS = ",，、:：“”\"—「」『』"


@lru_cache(maxsize=1)
def _luts() -> tuple[np.ndarray, np.ndarray]:
    """(folded character of each code point, 0 for none; class: 1 Latin letter, 2 ideograph, 3 digit or leet sign, 4 separator)."""
    t = tables()
    fold = np.arange(0x110000, dtype=np.uint32)
    hit = (t["offsets"] >= 0) & (t["lengths"] > 0)
    fold[hit] = t["pool"][t["offsets"][hit]]
    fold[t["lengths"] == 0] = 0
    fold[0x300:0x370] = 0
    kind = np.zeros(0x110000, np.uint8)
    for c in range(0x3000):
        f = int(fold[c])
        if f and not 0xD800 <= f < 0xE000:
            fold[c] = ord(chr(f).lower()[:1])
    for c in "abcdefghijklmnopqrstuvwxyz":
        kind[ord(c)] = 1
    kind[0x3400:0xA000] = 2
    kind[0x20000:0x30000] = 2
    for c in "0123456789@$!+":
        kind[ord(c)] = 3
    for c in SEPARATORS:
        if kind[ord(c)] == 0:
            kind[ord(c)] = 4
    # the newline stays apart from other white space: two of them end a sentence
    fold[10] = 10
    fold[13] = 0
    return fold, kind


def _same_letter(text: str) -> str:
    return text.replace("l", "i")


@lru_cache(maxsize=1)
def automaton():
    """(automaton over the folded lexicon, masks by first letter, last letter and length)."""
    import ahocorasick

    a = ahocorasick.Automaton()
    entries: dict[str, list] = {}
    masks: dict[tuple[str, str, int], list] = {}

    def add(raw: str, what: tuple, masked: bool = True) -> None:
        word = raw.strip()
        inside, open_ = word.startswith("*"), word.endswith("*")
        word = word.strip("*")
        latin = word[0].isascii()
        entries.setdefault(_same_letter(word.replace("-", " ")), []).append((what, latin and not inside, latin and not open_))
        if masked and latin and " " not in word and len(word) >= 4:
            for full in [word] + [word + x for x in ("s", "ed", "er", "ing")] * open_:
                masks.setdefault((full[0], full[-1], len(full)), []).append(what)
        elif masked and not latin and len(word) >= 3:
            masks.setdefault((word[0], word[-1], len(word)), []).append(what)

    for category, roles in LEXICON.items():
        for role, weights in roles.items():
            for weight, words in weights.items():
                for w in words.split("|"):
                    add(w, (category, role, weight), role in ("insult", "curse", "dehumanise", "act", "body"))
    for k, verb in enumerate(VIOLENT.split("|")):
        for object_ in ["you"] * (k < AT_YOU) + HURT.split("|"):
            add(f"{verb.strip()} {object_.strip()}", ("abusive", "violence", 0.6), False)
    for kind, (weight, _, words) in enumerate(CONTEXTS):
        for w in words.split("|"):
            add(w, ("context", kind, weight), False)
    for w in HARMLESS.split("|"):
        add(w, ("harmless", "", 0.0), False)
    for w in ADDRESS.split("|"):
        add(w, ("address", w.strip() in ("you", "your", "youre", "yours", "你", "您"), 0.0), False)
    for word, what in entries.items():
        a.add_word(word, (len(word), what))
    a.make_automaton()
    return a, masks


def stream(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded characters, their rows, the number of clause signs before each)."""
    fold, kind = _luts()
    c = fold[codes]
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    keep = c > 0
    c, row = c[keep], row[keep]
    if not len(c):
        return c, row, np.zeros(0, np.int64)
    clause = np.cumsum(np.isin(c, np.array([ord(x) for x in CLAUSE_SIGNS], np.uint32)))
    # two line ends, or a stop, end a sentence; one line end is a space
    line = c == 10
    pair = line & (np.concatenate([[False], line[:-1]]))
    c = np.where(pair, BREAK, np.where(line, GAP, c)).astype(np.uint32)
    stop = np.isin(c, np.array([ord(x) for x in STOPS if x not in LEET], np.uint32))
    c[stop] = BREAK
    new = np.concatenate([[True], row[1:] != row[:-1]])
    # digits and signs inside words: a token is a run of letters and leet signs that has a letter
    k = kind[c]
    token = (k == 1) | (k == 3)
    starts = token & (new | ~np.concatenate([[False], token[:-1]]))
    run = np.cumsum(starts) * token
    letters = np.bincount(run, weights=k == 1, minlength=run.max() + 1)
    leet = (k == 3) & (letters[run] >= 1) & (run > 0)
    if leet.any():
        table = np.arange(128, dtype=np.uint32)
        for x, y in LEET.items():
            table[ord(x)] = ord(y)
        edge = (c == ord("!")) & ~np.concatenate([token[1:] & (row[1:] == row[:-1]), [False]])  # a mark at the end of a word
        leet &= ~edge
        c[leet] = table[c[leet]]
    c[(c == ord("!")) | (c == ord("?"))] = BREAK
    k = kind[c]
    # a separator between ideographs, or between letters that stand alone, is dropped
    apart = k == 4
    word = k == 1
    before = np.concatenate([[0], k[:-1]])
    after = np.concatenate([k[1:], [0]])
    between_cjk = apart & (before == 2) & (after == 2)
    left_word = np.concatenate([[False, False], word])[: len(word)]
    right_word = np.concatenate([word, [False, False]])[2:]
    between_letters = apart & (before == 1) & (after == 1) & ~left_word & ~right_word
    # the outer neighbours of single letters may only be words at the ends of the run of separators
    single = word & (before != 1) & (after != 1)
    prev_single, next_single = np.concatenate([[False], single[:-1]]), np.concatenate([single[1:], [False]])
    drop = between_cjk | between_letters | (apart & prev_single & next_single)
    drop &= ~new
    out = ~drop
    c, row, clause, k = c[out], row[out], clause[out], k[out]
    # other separators become one space; a dash inside a word stays a boundary
    c = np.where((k == 4) & (c != ord("*")) & (c != ord("'")) & (c != ord("’")), GAP, c)
    quiet = ~((c == ord("'")) | (c == ord("’")) | ((c == GAP) & np.concatenate([[False], (c[:-1] == GAP) & (row[1:] == row[:-1])])))
    c, row, clause = c[quiet], row[quiet], clause[quiet]
    c = np.where(c == ord("l"), ord("i"), c)
    return c.astype(np.uint32), row, clause


MASK = re.compile(r"(?<![a-z*])([a-z])(\*{2,})([a-z])(?![a-z*])|([\u3400-\u9fff])(\*+)([\u3400-\u9fff])")


def sentence_scores(found: list[tuple[int, int, tuple]], clause: np.ndarray, sizes: np.ndarray, text: str) -> dict[str, float]:
    """Score by category of one sentence from its hits (begin, end, entry)."""
    hidden = [(b, e) for b, e, w in found if w[0] == "harmless"]
    told = [(b, e) for b, e, w in found if w[0] in CATEGORIES and w[1] not in ("target", "intent", "scene")]
    near = NEAR_CONTEXT[not text[told[0][0]].isascii()]
    low, high = min(b for b, _ in told) - near, max(e for _, e in told) + near
    off: dict[int, float] = {w[1]: w[2] for b, e, w in found if w[0] == "context" and e >= low and b <= high}
    addresses = [(b, e) for b, e, w in found if w[0] == "address"]
    spoken_to = any(w[0] == "address" and w[1] for _, _, w in found)
    roles: dict[tuple[str, str], float] = {}
    words: dict[tuple[str, str], set[str]] = {}
    insults: list[tuple[int, int, float]] = []  # the longest of those that overlap
    for b, e, (category, role, weight) in sorted(found, key=lambda x: (x[0], -x[1], -x[2][2])):
        if category not in CATEGORIES or any(x <= b and e <= y and (x, y) != (b, e) for x, y in hidden):
            continue
        if (category, role) == ("abusive", "insult"):
            if not (insults and b <= insults[-1][1]):
                insults.append((b, e, weight))
            continue
        seen = words.setdefault((category, role), set())
        if not any(text[b : e + 1] in x for x in seen):
            seen.add(text[b : e + 1])
        roles[category, role] = max(roles.get((category, role), 0.0), weight)
    for key, extra in SECOND.items():
        if len(words.get(key, ())) >= 2:
            roles[key] += extra
    if insults:
        roles["abusive", "insult"] = sum(w for _, _, w in insults)
        for b, e, weight in insults:
            near = NEAR_LATIN if text[b].isascii() else NEAR_CJK
            before = any(y < b and b - y - 1 <= near and clause[y] == clause[b] and not OTHERS.search(text, y + 1, b) for _, y in addresses)
            share = sum(y + 1 - x - text.count(" ", x, y + 1) for x, y, _ in insults if clause[x] == clause[b]) / max(1.0, sizes[clause[b]])
            if before or weight >= 0.6 and share >= VOCATIVE:
                roles["abusive", "address"] = ADDRESSED
    if spoken_to:
        roles["abusive", "you"] = SPOKEN_TO
    sums = {c: sum(v for (k, _), v in roles.items() if k == c) - sum(w for k, w in off.items() if c in CONTEXTS[k][1]) for c in CATEGORIES}
    strong = {r for c, r in roles if c == "abusive"} & {"violence", "curse", "dismiss"}
    if sums["hateful"] >= FOUND and sums["abusive"] < 1.5 and not strong:
        sums["abusive"] -= roles.get(("abusive", "insult"), 0.0)
    if not strong and not insults:
        sums["abusive"] = 0.0
    if not {r for c, r in roles if c == "hateful"} & {"dehumanise", "exclude"}:
        sums["hateful"] = 0.0
    if not {r for c, r in roles if c == "sexual"} & {"act", "body"}:
        sums["sexual"] = 0.0
    return sums


def row_scores(texts: pa.Array) -> list[dict[str, tuple[float, float]]]:
    """For each row, by category: (sum of sentence scores, largest sentence score)."""
    codes, offsets = to_codepoints(texts)
    chars, row, clause = stream(codes, offsets)
    results: list[dict[str, tuple[float, float]]] = [{} for _ in range(len(texts))]
    if not len(chars):
        return results
    # punctuation between words is dropped where it would part a phrase, but the clauses it ends are kept in mind
    mark = np.isin(chars, np.array([ord(x) for x in '"“”„«»,:()[]{}<>'], np.uint32))
    keep = ~mark | np.concatenate([[True], chars[:-1] >= 0x2E80])
    chars, row, clause = chars[keep], row[keep], clause[keep]
    if not len(chars):
        return results
    new = np.concatenate([[True], row[1:] != row[:-1]])
    clause = np.cumsum(new | (chars == BREAK) | np.concatenate([[False], clause[1:] != clause[:-1]]))
    sentence = np.cumsum((chars == BREAK) | new)
    text = chars.astype("<u4").tobytes().decode("utf-32-le")
    a, masks = automaton()
    letter = np.zeros(0x110000, bool)
    letter[ord("a") : ord("z") + 1] = True
    is_letter = letter[chars]
    hits: dict[int, list[tuple[int, int, tuple]]] = {}
    size = len(text)
    for end, (length, what) in a.iter(text):
        begin = end - length + 1
        if row[begin] != row[end]:
            continue
        left = begin > 0 and is_letter[begin - 1] and row[begin - 1] == row[begin]
        right = end + 1 < size and is_letter[end + 1] and row[end + 1] == row[end]
        for entry, needs_left, needs_right in what:
            if needs_left and left:
                continue
            if needs_right and right and not (entry[0] != "address" and text[end + 1 : end + 2] == "s" and not (end + 2 < size and is_letter[end + 2])):
                continue
            hits.setdefault(int(sentence[begin]), []).append((begin, end, entry))
    if "*" in text:
        for m in MASK.finditer(text):
            head, stars, tail = m.group(1, 2, 3) if m.group(1) else m.group(4, 5, 6)
            for first in {head, "l" if head == "i" else head}:
                for last in {tail, "l" if tail == "i" else tail}:
                    for entry in masks.get((first, last, len(stars) + 2), ()):
                        hits.setdefault(int(sentence[m.start()]), []).append((m.start(), m.end() - 1, entry))
    sizes = np.bincount(clause, weights=is_letter | (chars >= 0x2E80) & ~np.isin(chars, np.array([ord(x) for x in CLAUSE_SIGNS + STOPS], np.uint32)) | (chars == ord("*")))
    for number, found in hits.items():
        if not any(w[0] in CATEGORIES and w[1] not in ("target", "intent", "scene", "contempt") for _, _, w in found):
            continue
        r = int(row[found[0][0]])
        for c, s in sentence_scores(found, clause, sizes, text).items():
            if s > 0:
                total, most = results[r].get(c, (0.0, 0.0))
                results[r][c] = total + s, max(most, s)
    return results


SCHEMA = "doc_id bigint, " + ", ".join(f"{c}_score double, {c}_peak double" for c in CATEGORIES)


def scores(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, <category>_score, <category>_peak) for every document: score for each 1,000 characters, best sentence.

    The columns named by `keep` are passed along.
    """
    names = ["doc_id", *(f"{c}_{k}" for c in CATEGORIES for k in ("score", "peak")), *keep]
    kinds = dict(documents.dtypes)
    schema = ", ".join([SCHEMA, *(f"`{c}` {kinds[c]}" for c in keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                found = row_scores(texts)
                size = np.maximum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), 1)
                cols = [batch.column(0).slice(at, len(texts))]
                for c in CATEGORIES:
                    pairs = np.array([f.get(c, (0.0, 0.0)) for f in found]).reshape(-1, 2)
                    cols += [pa.array(np.round(pairs[:, 0] * 1000 / size, 6)), pa.array(np.round(pairs[:, 1], 6))]
                yield pa.RecordBatch.from_arrays([*cols, *(batch.column(2 + i).slice(at, len(texts)) for i in range(len(keep)))], names)

    docs = documents.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *(F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep))
    return docs.mapInArrow(run, schema)


def flagged(documents: DataFrame) -> DataFrame:
    """(doc_id, category): one row for each category of which a sentence of the document reaches FOUND."""
    kinds = F.array_compact(F.array(*(F.when(F.col(f"{c}_peak") >= FOUND, F.lit(c)) for c in CATEGORIES)))
    return scores(documents).select("doc_id", F.explode(kinds).alias("category")).distinct()


def rates(documents: DataFrame) -> DataFrame:
    """(source, documents, <category>_documents, <category>_rate, <category>_mean): rates by source; a null source is its own group."""
    scored = scores(documents, keep=("source",))
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        *(x for c in CATEGORIES for x in (F.count_if(F.col(f"{c}_peak") >= FOUND).alias(f"{c}_documents"), F.round(F.avg((F.col(f"{c}_peak") >= FOUND).cast("double")), 6).alias(f"{c}_rate"), F.round(F.avg(f"{c}_score"), 6).alias(f"{c}_mean"))),
    )
