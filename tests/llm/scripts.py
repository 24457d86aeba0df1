"""Clean prose of languages without a fertility band of their own; Chinese, Japanese and Thai words are parted by blanks."""

CLEAN = {
    "ru": ("Все люди рождаются свободными и равными в своём достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. Каждый человек имеет право на жизнь, на свободу и на личную неприкосновенность.",
           "Вчера вечером мы долго гуляли по набережной и смотрели, как рыбаки чинят старые сети. Потом начался дождь, и пришлось спрятаться в маленьком кафе, где хозяйка угостила нас горячим чаем с мёдом."),
    "uk": ("Всі люди народжуються вільними і рівними у своїй гідності та правах. Вони наділені розумом і совістю і повинні діяти у відношенні один до одного в дусі братерства. Кожна людина має право на життя, на свободу і на особисту недоторканність.",),
    "el": ("Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.",
           "Χθες το βράδυ περπατήσαμε πολλή ώρα δίπλα στη θάλασσα και κοιτάζαμε τους ψαράδες που έφτιαχναν τα παλιά τους δίχτυα. Ύστερα άρχισε να βρέχει και μπήκαμε σε ένα μικρό καφενείο."),
    "ar": ("يولد جميع الناس أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء. لكل فرد الحق في الحياة والحرية وسلامة شخصه.",
           "مشينا مساء أمس طويلا على شاطئ البحر وشاهدنا الصيادين وهم يصلحون شباكهم القديمة ثم نزل المطر فجلسنا في مقهى صغير وشربنا الشاي الساخن مع العسل."),
    "he": ("כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה. כל אדם יש לו הזכות לחיים, לחירות ולביטחון אישי.",),
    "hi": ("सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
           "कल शाम हम नदी के किनारे बहुत देर तक घूमते रहे और मछुआरों को पुराने जाल ठीक करते हुए देखते रहे। फिर बारिश शुरू हो गई और हम एक छोटी दुकान में चाय पीने बैठ गए।"),
    "ko": ("모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다. 모든 사람은 생명과 신체의 자유와 안전에 대한 권리를 가진다.",
           "어제 저녁에 우리는 바닷가를 오래 걸으면서 어부들이 낡은 그물을 고치는 모습을 보았다. 그러다가 비가 내리기 시작해서 작은 찻집에 들어가 따뜻한 차를 마시며 이야기를 나누었다."),
    "ja": ("すべて の 人間 は 、 生まれながら に して 自由 で あり 、 かつ 、 尊厳 と 権利 と に ついて 平等 で ある 。 人間 は 、 理性 と 良心 と を 授けられて おり 、 互い に 同胞 の 精神 を もって 行動 しなければ ならない 。",
           "昨日 の 夕方 、 私たち は 海岸 を 長い 間 歩いて 、 漁師 たち が 古い 網 を 直す の を 見て いました 。 それから 雨 が 降り 始めた ので 、 小さな 喫茶店 に 入って 温かい お茶 を 飲みました 。"),
    "zh": ("人人 生而 自由 ， 在 尊严 和 权利 上 一律 平等 。 他们 赋有 理性 和 良心 ， 并 应 以 兄弟 关系 的 精神 相 对待 。 人人 有权 享有 生命 、 自由 和 人身 安全 。",
           "昨天 晚上 我们 在 海边 走 了 很 久 ， 看 渔民 修补 旧 渔网 。 后来 下 起 雨 来 ， 我们 就 进 了 一 家 小 茶馆 ， 喝 着 热茶 聊天 。"),
    "th": ("มนุษย์ ทั้งหลาย เกิด มา มี อิสระ และ เสมอภาค กัน ใน เกียรติศักดิ์ และ สิทธิ ต่าง มี เหตุผล และ มโนธรรม และ ควร ปฏิบัติ ต่อ กัน ด้วย เจตนารมณ์ แห่ง ภราดรภาพ บุคคล มี สิทธิ ใน การ ดำเนิน ชีวิต",),
    "vi": ("Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hóa ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình bằng hữu.",
           "Tối hôm qua chúng tôi đi dạo rất lâu bên bờ biển và ngắm những người đánh cá vá lại mấy tấm lưới cũ. Sau đó trời bắt đầu mưa nên chúng tôi ghé vào một quán nhỏ uống trà nóng với mật ong."),
    "pl": ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek ma prawo do życia, wolności i bezpieczeństwa swej osoby.",),
    "cs": ("Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat v duchu bratrství. Každý má právo na život, svobodu a osobní bezpečnost.",),
    "tr": ("Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. Yaşamak, hürriyet ve kişi emniyeti her ferdin hakkıdır.",),
    "it": ("Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza. Ogni individuo ha diritto alla vita, alla libertà ed alla sicurezza della propria persona.",),
}
