"""Words and word parts of three or more letters, most common first: the pieces of the public tokenizer
``piece_bpe_32k.model`` in their order, lower-cased, those of ASCII letters alone."""

COMMON = (
    "the ing ion and ent ver ation for ter you that ith est con ate ist with ere was ers out ess res end ort our ill ain pro ore com ame rom ant art ction "
    "urn ight all this ser ave not are age ment ack ust ity ine ould from ell ure port per ard ass ive ies ath turn int ost ial have ind ans his ult rou "
    "able ome get ast ect ice ire ber one ich hen can ime ile ide orm had ase ord her ace but ata ong ite ype act ode your lic ally ork they ions ach ens "
    "elf ook ated ang ign return ous ail ance ther ake will comp ary ock she che new des ence ress und fer ear ose very ublic their ize were ink own has "
    "ject ild row alue set form man ont ull cont more ick would about ition ound ree which who err ory ount ations ring dis them any pre him ark ient ely "
    "import time user ors there like old when vers some ings part ical fun ays ier been ove ian over iel rib put eth aram app stat pon what ption ade work "
    "text said just irst into const ource erv itt ents ish ener inter ple oll mer ater ool public other def oint off oid fter riv iss than pect ied iew der "
    "yst could ann enc anc also reat bec ual pec lect ople ict tring back fin atch erm name did ise only ruct les then ause its rit know ield class year "
    "del ale fig hed round red let essage ough comm uch people ystem first function ange how look under ray ific read bet ious arg need math ert acc rec "
    "use par self want don ren que igh equ vel cre var cess add mod ung where ning als tern pos ank eng ble reg ude two col air may fore rough att oth ates "
    "rem ood type led ful every ref rel even hand ait should after dif ght ife ator ash ribut umber see call make str long lement wor alse ward val ons now "
    "data amp ense through down static ics void oun way ible vent ower think again ating ner most line sub erson requ abel ond alk because ger ular roup "
    "cons right ily ead else som rent ement ault sert ins ident prov true ues inst ames sur param start ask string play ting ton before pol arch well olog "
    "these ars incl hel ern ody good ider min much els cur value ery loc reak ative imes die trans result ext aut land ten cond ices fil ities produ case "
    "ather spec ility does here ures null rap list ational being car ole dist plic ollow pres such ream ince gan son rivate years serv made bel cor det "
    "ception egin char fam ouse dec ica many aking sim ages uff ased iet irect differ find ethod ines inv point used ctions still ined while ember say help "
    "ument ought ually message mon ared ister arn ized orn head person ments ength false med ache ited show same uss gener real ced struct begin cept ired "
    "stud dev ween too test day follow ature ien ces uring amb ina cri uck take ule cal source those eff around press going ponse date code life ason using "
    "found olut arent met ush size each last got ven rol thing ret ism between ething ats ado dex pass den apt sup try lation ness ets exper mar number "
    "inal cent ional final run never high yle best ittle ric sign dem iness war ished giv key child less ways rop raw indow riend los file formation ccess "
    "ision ler world really ters arget happ div didn ada oot sch cle something cour ever ants ais ross hip rep label both ott ane open come ched ify view "
    "bus must different log ists roll system ivers atus ote akes gram private great opy feel ains lock mat home perty wom arly eter includ mem little "
    "include eta place idth ustom tem ried fact ience opt ele ots ral ique aving thought frac care might amer ample alth few state without poss expect "
    "second uild next men iter ament net ron aint pend translation van another post ware word error seem contin atic three object partic mark vis ptions "
    "break things ute urs igned lead ained path small ager always order won ape left ava item hor away process support oper load ives ican action aining "
    "ior init lection arm umn ags version stand ift ein face ified ved sum une ital ump mov elt von velop ctor build inc info chn week book bar icense "
    "quest urch ato top friend beh field against ract ization chen keep itor non ird ope rest una term pop rist since ves hard util soc ene exception local "
    "direct sure bro current information better raph check outh aps unt conf spe itle ural bers ession eas ervice aus ari coun ling ably pat org tell lex "
    "allow reen consider team lease htt sing ides ches ially ided free proble cite ission during ither leg sit ically tra mom expl develop event ohn "
    "business prof por commun ium ouble rite ready ped ived arl power ribute talk itch called came belie aster ella obal until hum ately room len family "
    "program hist mus arge oney ails love ases pha ours map iver ateg ertain effect print big index pub vert ero method game ries lete resent ality pty ley "
    "ocument beg school hes lot took adv cap unk light later itions enough went though group mean num given why rece side far context aces ency oad ered "
    "product prote tes olution month ference appe ened tract give kind count stop gover ences mil alf ync vious night era sol water ering lim house pay uro "
    "oci already length interest aff cted ention ume appro bre throw mathcal irl prom oss request equation ology mit pack ino array til present organ orig "
    "full istr flo assert ards url enn cho level body main ploy super oken thers days done vol tot john orth ico perform ailable config model ales create "
    "ances ination ante ana told ently door ential node ively asked irt report chang along change occ ury mind whe important writ eyes desc bit success "
    "core lin lish following ids hing aring lev alt alpha four law iron disc ken move license cul ione sel once service bol ured ida grow conne walk nal "
    "ender cription mber lected nil prob ste ison ands osed element search mag course exp aph doesn default aim within angu uffer incre understand looked "
    "gen ailed ayer bas job elta christ uration record univers ivid valid hold table ones link offer ster stance govern techn prim max polit ories times "
    "dans anything sever acy least ips cost children ability acter wait money oin iving icht icy ored oud ille ised plication custom having ponent ules ued "
    "atter itive moment aterial ograph ike large either duct olean pert short iment project cript including making someone sat company ocus god ification "
    "ano cou ended ober nothing pot typ rew young nder women looking health mult orld input supp ainer heck mor mill doing tings ades toget certain "
    "together ideo american ony idd ged ables iod parent ambda ando aged ending possible ivity ajor ride knew itional lik ension oto exist aken actually "
    "inn buf seen ops control respon ilt isk bad often past aper reason eters wanted ura ormal width ptr dest design sound plan base says tri invest "
    "available ayout och las illed iety iam pace para meet ici known amma arr tre oke uth experience icle sent others soft ball market pour pression eps "
    "saw across ulation ources wards black ili complet single ached bool area require problem aced vec ney account ymbol ges empl ecut target getting ogle "
    "himself wasn block york become iff ports reate location access gress ros working iqu cer func girl above pen ido mary abled annel example cir space "
    "fut ills dri felt offic started front almost irm signed yet trad ients ama camp ibr fect half cover anguage ben diff odes ios mot social stre ground "
    "ples reed een based range urg learn exc imp means wur ends std particular scri status story position special php pract das rad close www dom bed "
    "several aul box low atures eder uilder cast conom raft makes http abs resh options fort anal env page ternal distribut food whole turned igma response "
    "university apter results represent everything utes rix behind creat umb mathbb ping match situ ara window lished human perties lem early quick roid "
    "country due trying live oved specific fall general names sil address answ film strong bring united woman ett ename describ ising fur ying angle urope "
    "city however ias question jan amed plied tty individ comb section uel het agement major api hab auf qui idea required heart ibility iction write "
    "content wer hands zen mass ply nat dat imal probably unch ilar ires watch cult mother government ording pri near ito values java fully white ctx conc "
    "stay ging clear copy selves provide words args pick uly vari believe property ischen eturn ival total uments manager win leep ruction inte avor "
    "respect ators como cut sus rect began oph sort icro relations father sex isch aven itten ights hom today ita isn ogn whether ixed phi idence ald "
    "client death ius avel miss color obt ette crit atal dark larg ding ouch elect dam needs matter rather ram taken deal period aug elle export abor "
    "author remember redu focus character individual needed bum style inary ersion oute hon mut became dire document sec ening visit fac plit phys itting "
    "joy hig brit employ lambda impro iding online atform cas asure pur medi germ friends plus iddle itut depend entire query refer hot aust common pull "
    "season invol append itted empt prop imate hours hope andom istic personal rown foot research ironment nom instance held members fire history discuss "
    "espec taking services indust igen expected wurde dir among sugg pain five fund rid arrow treat heard determ icult sense ese months json orage everyone "
    "clos iers airs define osp wonder ites material html gave suggest override rodu europe soon host har energy aves easy frame inside ief pan igr omet "
    "music ora iles esc bes comes future lick aid compet voice evel neg command pie quite blo agn ilon claim teach previous site attr accept exact aft "
    "roller pretty image terms dav src incip couldn ados dro beta imum minutes grand maz original ini coll loat summary wall della mathbf zer aur track "
    "associ suff inde ague apr roups board attack series instead ham six coming urt global necess lege leave pod ategory deep outside rows states wrong sem "
    "catch option rie enjoy pas amount respons intern myself opp sens students points arning elling cannot uint wise double ige ista estab anch ago bound "
    "clean simple ifier seemed ena endif caus educ cell beaut limit national ows quad arth hat community oul econom component bor usion below earch ores "
    "ban august further sigma comput none anyone task ente pped attribute req addr upport san writing lost gre south perfect package infl haps ris ptember "
    "building roy achine nown saying network uge similar builder living continue anger hair anced ians dead boolean ication uct older udio deg asing step "
    "pers obj ula upon resource bug span ialog phot cam pected town align webs inner augh except initial enty lich fail ona benef anks ische signific "
    "contact ario ottom relationship format actory portun simply russ erc longer inition ector aption profess ilities offset band icon works ynam plement "
    "difficult west video decl ondon ded ocr uer imag ete idget forward pict orge subject update attle running sal output adata ledge paper params avy eine "
    "jour itself million language ving buy tried compl activ apped button token provided iber created curity uster izing omb sich compon ocol received road "
    "oct study tour added https stream lower themselves cross echo device pose games ises title role iant sequ late sold entre dog likely paul tool famil "
    "draw apping events cret rought software ria msg gamma hear yourself liter emp separ mathrm slow tax emplate astic ocket amente chie chema north dig "
    "seems morning sole umer delta abase raf observ seg iful push ipe ati dim ceed entry fight cred dep april ministr iem office third tag especially kill "
    "aught swe compan izer auto iques song ensor ining lat king quality mode opportun wouldn feet mis aging tro defined review princip dict verage icient "
    "hit perm cel express indic september products media igger send ming uary speak ysis lying mich jah ensive share development fast particip viol qual "
    "toward column milit march various park normal phone ibrary idden rho graph acing arter mes active fem moved store price berg nov card ellow party ael "
    "percent training imer sam fuck complete uid details regard recogn hol exam verse riter introdu surpr buffer lector aren anged pal contr handler "
    "features iple thinking doc worked immedi ovember apan extra june via gone stri antly conv london questions andid played natural news chall attempt "
    "rote written blood happened cause ashing william adem brought display ima finally tab returned nie hers dou effort aine histor enu arriv favor handle "
    "rupt force ube iny theta isf equal rench wife capt tau sleep issue member await dan inate sym chan jack english ributes appear idge couple ship lig "
    "web usually vill ebru grad ords inf loss phil server buff filename iting efore conditions eld itz weight higher rate accom vider etc avec takes "
    "november austral america cember political flow maybe layout iled omen ola icip partial floor concern shows answer rev sun quickly somet mente mal "
    "undred issues ecause pes player parents popular mention regular aved performance july thern website ford ela uit flags worth correspon british alone "
    "obile dru chi david problems relig ological region ady ander built install approach fine talking changes mart teger irit protected rele ership "
    "unsigned ialize ypes etch engine cmd script ttp avoid terr rock environment prec cases rais lib opyright feature posed ffect itude ements asc ador "
    "lections club imm former rights decided ani stru attention artment alle bis integr ello rypt achie nes stra types comment addition squ considered idad "
    "october cial travel boy illa istry ende ungen aby rober playing ils execut bal asse kids financ gor bert kept itory reach bur passed behav xff ala "
    "inger experi shall star gun ares weeks nen oring serious register module applic cook aux save empty autom figure iance happy jud ivil oted sizeof "
    "situation lives feeling risk january recomm potential eah complex printf istance irth aste whose modern iones sett condition fit ounds changed guy "
    "filter atever remove hop rich included tom eline sometimes drink quant please rief exactly cing allowed beautiful looks chance wrote nor failed prior "
    "hundred oria mess leq tex anim atur structure actual franc enced afr ety stuff itter album ugin circ correct lines completely tree root japan oles "
    "endo mid aling iano lang equip memory nature google gets aled purch herself sie gar nel ota acht irtual police skin efined aughter inding influ mount "
    "wood otes ega according namespace stant published aker industry choice aud standard knowledge frank ugh books james companies anning vict repl sche "
    "happen fty acity ira implement iro fear touch consist sig igation ali iner distributed mur career aries enses unique france febru died omega tocol lie "
    "straight nach stood olds goes till satisf reading additional cil bill mas ania anz height dos production iger population necessary trust shown lay "
    "announ classname calcul items security float ibly contribut improve systems policy screen opened alloc december email ader switch urance assum ustr "
    "groups wat ran hib hus french president definit thom aign agon followed asons tmp throws fair interface saf oon speed extends proper driv center "
    "header middle choose stad factory icles application models pite ospital dream contract icrosoft thous izes direction drive cia continu alex gold prep "
    "origin ously areas safe professional apache temper unit cop eqn listener select comfort meant iday eme note neigh blue reached closed inder olo adm "
    "frequ independ easily tor ography infty iven county parse fol entity pgf china hood fields yes rend towards staff station atives impact directly "
    "issions iva sant progress itar parts plant absolut guess eqref tim lou cool alu mouth gest tit hour players rier construct rying shop iana helper "
    "aches connection difference gas priv wish geb ensions prem dies average xim ker named decision george arily solution multiple ategy learning secret "
    "nice itation join elements emer tilde shot platform othing edia oms aily dress official estern discover oding affect stract iced debug related spect "
    "ushed bank cele olf fill gives aron jes sudd dated cpp spent ande operation inform yond perhaps surv concl raz giving released practice increase idx "
    "glass ski cat cold goto ufact copyright streng occur arlier measure argument sou moving prefer mask breath physical positive sor depart kit meeting "
    "ograf actions parameters esch involved ech prevent beyond byte sudden olve truth rat eat mad provides session dele convers continued otion cache "
    "protect ams pow mac distance wide cru pattern provider green waiting proto immediately azione river sen february urb edge mais gorith cpu education "
    "associated poor wil bud auch eller files leading obtain jul atory itable onto born orem street maint rip recent ova aise yles described beginning huge "
    "ancy ensure pet management background ounter excl eye img stopped thread totype stage although eight description surface international charg "
    "collection users obvious century icks article sin enge commit ensity criptor michael nod mort ivo isation paris administr burg cdot military "
    "throughout impl threat court ville currently rot shit unn sont letter inated href lack oil jer iforn properties random brother piece istics technology "
    "transform erd pret psy voor includes olutions wind numer goal ashington slight aba settings adow iring numbers receive india patch summer methods "
    "places capital evidence german ecute functions counter arms feed vey hent acqu apply husband killed earlier setting itect financial lear ishing nearly "
    "dur machine symbol lands robert urity walked release starting bei parameter ampions kom leted ois fue acters reference equals aware demand lor veh "
    "notice analysis effective legal semb located inct eto scale wants wel isions deliver deb sister menu cab lif culture iche whatever designed repe mont "
    "charge insp customers osa daughter east opin fre seek nav burn arden hash opportunity oyal pun ynamic iling mist ror medical student ederal lov iform "
    "altern bin oder returns uts amily aire controller rowser container pload tal theory eqnarray reported meaning ribe icate offers templ css picture "
    "async stock internal demon laugh kon ideas candid izz refix egen campaign rob bul countries expression england certainly agen connect android oppos "
    "overn asion firm erve brand jew iler ingle ithub cert rael itute amaz pulled resources agreed asy treatment cos otal train spirit sqrt broad shape "
    "atalog meas interesting useful useum bottom otherwise agree cht significant channel icial vare enter queue ono contains nation rules arp quiet thus "
    "ipped annot udes compos inj bind ras utils anges dule christian reve collect celebr anda paid fif uma ervices recently heavy rule psi console "
    "washington interview anned sql concept selected ears race steps ila ests eds ners birth epsilon constant ques adas knows cles cit pair inese peter "
    "finished master twenty fell central allows gro click stories baby encia einer ebug lam movie hous learned bon transfer ifornia psilon commer hadn "
    "craft argin estim ika tod duc danger rive hal distribution plicit epis assist purpose iders strugg shoot loved reserv spread miles successful growth "
    "church sten ses delete crow blog computer mir multi gru canada thomas larger compar drop republic dise effects girls encies ellig uses elled warm font "
    "zum follows whom wild iable sell cher lean served atz characters zero rapper kitchen aming restr college fresh shift specified plete rial osen ignment "
    "adding degree zur levels riage vector sea antic league therefore vas behavior undefined appeared eles credit anging romise gent habit society encour "
    "paint aws onom eless emy cong developed images gin lord transport cup ulate extrem doubt ifying split ego github chair trade nicht parte nia caught "
    "doll harm etime cfg guys california movement iej statement seeing haven vention chedul iert primary civil rian lived watching skills tee scient agre "
    "tend gle ahead vest jose ischer leaving consum activities sales fix jed rum spot manufact orrow driver definitely spend mission atively callback "
    "particularly hell pool clearly othes fixed challeng standing iten mechan durch dell raised weak scene earth ulations strength aked remain customer "
    "interested coff farm activity rout bling richard jun ijn configuration uman married fat kid tur offered nic construction earn rict brain fra ema "
    "european saint uri sitting understanding plans ropri pressure peace shut apers rim auth highly unless wal clim ruit hest charles shared ulated gorithm "
    "village ees restaur rey organiz ponents werden bow ami basis ernel itu aan smile xml scen amm aria accur jesus acement calls basic ript ctors "
    "foundation weap radio helped mann jump tick growing aten increasing varepsilon sets advant reasons supposed oes ede teen ifdef reci acks iste dei sta "
    "limited greater ori aints mel surround arc telev itution israel caption exerc empor damage oded evalu ston norm adult hospital recommend stein aspect "
    "amento rac football ungs abil luck render sein ioni corner appropri tele prison rank existing vir trip avax heat convert exists sys tempor arguments "
    "supported ensed francis coord achieve jahr alla wit agment alls holding prototype fing bag stack economic gal idents showed osh bay mail graphics "
    "battle rior chaft favorite usive safety australia destroy organization iden seven arely flag carl doctor variety antes mine describe luc science "
    "investig demonstr objects louis han nam comme presence pel detect chinese classes expand peed jim smith pages jean rics sund ads unicip download "
    "stress reme compared indian oren roku established generally fle removed mix erk iation outer becomes hall scious watched gather proof produced border "
    "din ooth filled undle predict lui warran powerful lose atically daily arrived scope elij keys vid proced rant estival agram henry scription families "
    "isse bour brief creating clients rangle amazing sind covered sand murder bright trav icans placed attract anel bytes belong calling evening reek "
    "honest director solid iene fault cope reedom worse imo mex actor vor experiment happens uan patients wed insert anti ampionship forces phase template "
    "icated managed appoint stick suddenly urop insurance unfinished tamb sac missing sua thick trump operations deux odd reality teams oma cloud "
    "department requires iii rightarrow writer replace thr jen occup eventually conserv dry sexual costs forms framework tight invalid partner thank guard "
    "hem emot sci individuals optim factor smaller contain announced democr flat osoph ahl unter species este journal einem ismo projects rible serve "
    "opening hur programs usa iliar idos estamp tools anner bath coffee orter inval ako acional agg leader olved traditional rup materials syn produce "
    "storage subsection marketing plet dialog mentioned union negative txt easier novel eur carry schaft broken trees emb ieder route ikel listen ashion "
    "mrs equipment agger matrix conversation ournal minute forget levant temp telling independent tostring edit jac azz react cin isted onna iki generated "
    "psych entr assume sembly matt solutions faith digital excell carried reset slowly ancing owner nob gnu liber itness hij district jection lymp realized "
    "mos rio interpret slightly studies atre benefits ivery asking arante martin forced sky strategy ocked neck wie sweet foreign astr maximum annels tip "
    "seconds iga raise enable oir soul iser lichen abe concent stone transl vac andon sounds lia helps edy anted ialized aze carol critical seat aped upper "
    "explain dont approxim grab sources germany rub rain truly joined akt idae spoke walking nodded props enabled irk pping oli enz eting sample artist "
    "responsible caused theme acle hung textbf spin latest entially metadata password hurt sey allet sites obtained completed aset raid sorry fab schools "
    "scr incor spr commercial ingly opinion javax varphi connected adjust planning integer fant tou thoughts bob lict lan omic apart trou appreci christmas "
    "irq thon score rome neighbor admin strateg workers schema appa olic charl png hill owe mostly finish stars smart sad council gradu chem instr "
    "ifications sobre ingu spring nur advice ennis increased finding irty istrict layer igration rency owie selection polic database providing metal "
    "modules georg establish kin chapter dal principal remains definition signal volume hens wird election utt ental ifest overall blic editor aden cart "
    "uls bing camera fav errors println bern nab apparent presented remained wet despite mobile labor esp expert flex profession pil applied aller orph "
    "overline trouble mbox keeping kick corresponding library ums comments award bought includegraphics dot ronic extremely minor ifer endar plies island "
    "scott largest temperature reduce foi bod nullptr dating chain iento fan determine wear appropriate goals sar hate zijn implied bits skip mond prove "
    "traff intr pic dropped werd separate isa tml mutex hotel istan oting arks ych imagine icago eler africa ocks prz fucking picked bott failure apes uple "
    "purchase bird widget sunday consult utsch anto association sight profile female wid stret aat patient atl inet imary dut majority byid believed sle "
    "sequence pieces kne absolutely philip abilities kar devel electric rolled healthy extern coach asta compat exit shoulder jobs zone sale ixel "
    "determined anyway orf allel rees asm ims records corpor intellig driving marriage willing micro lift irection architect prin runs texas isher joe geq "
    "lets ading army otic cry grade ested gers ologie razy dinner fingers advantage variable medic male circum internet lab azine loop pred consequ balance "
    "fortun gift drug cash istribut highest emph emon performed closer becoming prepar vote ilde impress employees einen smooth snow purs voc microsoft "
    "income inos operator equival hout illy crete frak hidden roke eper square ester rawn audience ems sick horse benefit cro corre guarante explained flor "
    "reports uded citiz decide domain reflect minimum legs smiled pure essential observed rates mbre worry windows ulture relative seu shook iously advert "
    "batter oni prepared gate supply bolds trail fish units venue category foo influence enth rij adapt icians deleted vision ctrl aturday thousand disease "
    "clip boldsymbol challenge motion whis leaders colon suit ampion views appears ancel zwe leaves enh dit ificate reader mental embre decor arts upid "
    "erved boys isl phy agent components ictionary tests obs assess friday weather endant anna japanese cmp onym relax dates russian excellent showing "
    "daniel grew yield strict vehicle chest officer noon journey divers rik constr sust walls entirely cha ishes prime uten arse pute protection spl "
    "clothes ashed fait introduced unlock ansion americans indeed realize fro asket poll icol prev hyp lee pling ideal selector ucture wine possibly "
    "putting wearing thanks sport glad afford identity parties drag mai langle knowing regarding joseph dar animals extension btn aciones familiar holder "
    "liked iti beat minister exhib ician collabor quarter virtual owa jon amin uen imation oving testing sect apy transition ository odo generate native "
    "hun agnost proposed efforts intent isc protest holds ometry detail yer noticed requirements kins cars meta kil bron experienced remind ourse western "
    "tered devices pictures tut impossible rail feels icas illing accident notes oman parser discovered roman budget guide incred olar enden wave igt "
    "restrict generation alo ordered literally sir yeah density riz gain panel jet nella previously brown trigger ometimes icos ogen ructions kiss solo "
    "famous thro imit starts ipeline discussion truck aka critic propos batt nord innov crim axis conn runtime remaining oston royal vide chron rise delle "
    "rapid entered laws photo applications berlin arrest federal russia usual sion xture istent capacity cards iments chicago comfortable enemy yan updated "
    "ango osing rence congress defe tout freedom virgin argo traffic depth sides descriptor artikel narrow uto facebook tegr nik gran reshold wrap noise "
    "igu linux cks fans mach prices outs categ decre saturday liche academ communication nuc pective orial afraid animal turning dst mathfrak lers lots "
    "rose helping winter mock investment canad fly amil fighting religious furn surprised replied olymp pointed roud undo messages plane television "
    "thousands cris delay nombre istration wonderful manage dass recall relevant oom itet asi motor factors forest thm municip turns division disappe "
    "structor somewhere african institute grid teacher uries respectively alive pou changing afternoon orders pointer sav erg oked essions aret desire "
    "uture eating sports weren noted twice anx elim speech condu elles idade advance oca apshot tail ogy jeff iration kore leads bat adapter angular saved "
    "uniform businesses warn hetic amazon lake agreement perman containing strange stupid speaking prefix manner unte iot oven formed lit economy chosen "
    "oster stances awa confirm billion illustr ties aded ahn cath nonumber worst suggested stats cant kappa initi garden secure elli ldots secut extended "
    "anie museum passion akers ahr ologies occasion anes iente urer otimes poet adopt phere centre oves kir applicable visual okay oro opportunities "
    "repository rod shel launch conven cette hook fellow philosoph vin ferences hav iverse clin covery fashion broke payment lips ells iture proceed maria "
    "olver shouldn joh sov cancer exchange iller aga photos tiny idel outing cells obe plex tons concentr championship aly ierte totally ourselves ighter "
    "fmt tells variables intended izont plays seq cultural scream cipl timeout orte replaced abandon ellen bru irmed olt neut scape crowd iego escape sync "
    "eben ifies ether biggest transaction plenty motiv cknow surprise cean pdf attend fond understood mic oking stadium competition soldiers agne anton pyx "
    "accepted monitor pad onic pushed matches experiences ups existence thin magn wurden teeth stan anny ifts unknown homes cie iar compliance focused uzz "
    "allery identify offering busy ctl itors concerned clk egy icing topic trial weekend nove lett enne promise ril conduct maintain boat opposite webpack "
    "anta orient suc exercise efficient tradition sud pier ipes ensuremath conver creen terror ceived arab wire generic directory egg wealth hide serial "
    "ployment massive extract bear links newsp aks visible marc boston reserved roof licenses witness uding trend musical neither positions ridge officers "
    "violence acket acer remark sed photograph letters invent songs dust nabla cluster reject wedding grav ression listed hline chief expensive trace rog "
    "recon esta properly leton iker oco anymore taste santa gex talent moments extr commission modify domin plot enger utch cities nut nodes essages icker "
    "examples abeth stated dangerous monday esome igan rund prise linear dop nou claims enda crazy gel oggle representation inen alternative faces doors "
    "ativ appearance silence udo ignore colors ushing virt remote crime creation flight vom oop warranties repeated roz isbn irts poses bles iat contrast "
    "joint external erman mike senior recorded eling esh tall johnson sono anche icken iciency emporary relation ichte jones bedroom magnet feelings torn "
    "relationships proud twe oval waste reduced ilton forgot bodies haw lag sufficient dollars talked bond quare lights eren thirty todo respond heav mixed "
    "desk teaching maj nerv inations typeof coast beside ummy schedule recover steel boot rick pis xpected processing arian wick algorithm ancient oti "
    "combination dram aration blocks angeles succeed oblig springframework okes mun estate liqu pob dad distinct ferred subsequ florida subset whisper "
    "ulous crew lug pid ocity skb tea honor gew eneath atar amen setup blank loor ncia anywhere excited agers warning processes youth dogs nine importance "
    "estic carefully decisions pin crack vast faster institut annual episode delivery typically igo intel jos gonna jor onia orship overy compare apartment "
    "rul gency obviously zie ycl fortunately stepped endor permission studied accompl protobuf plements disable loud happening depends taught attributes "
    "dess houses bien explicit oice authority unable sector hang itate amber cheap hier ntax uda limitations studio circle laug acts pled expr laughed "
    "fundament inher liv bid responsibility checked pac yellow salt francisco beauty magic numerous hole rooms buildings plate bled dimension iale blow "
    "erra passing phas ensional cohol harry izontal finger younger heim storm buying essed damn meg umes silver ardo communities diet otted ancer enum "
    "matters kan hentication complic apse dance permissions warrant lad isol terrible eral implementation hearing diss durante osis tasks branch politics "
    "leadership techniques imately achment creative appy unched onder narr winning resents zione latter requests margin allowing combined instanceof igin "
    "pero confidence equivalent bridge aya treated forth accounts listening cpy reform somehow umin considering premi athan planet amples premier simpl "
    "segu tables ska sous conference scroll standards esse citizens occurred elev ensus headers chris imento usher formal igne organizations pray bomb mand "
    "erts clock buck ensch volt films plants inode restaurant debut wordt greatest uent bigger perfectly tenance nose iteral discussed jewish jackson lunch "
    "atr paying rare unc defense soviet australian gli variant loan committee spending sugar elly advent wing oration iveness conscious logger widet "
    "ocation symmet posts shal chose ulo missed thlet pul advanced aires ressed bell aching funny eer veget fourth grown mcc beneath shell religion inator "
    "eliz vez reich vet welcome nament cycle acknow wound idi possibility annotation technical fold istence reply etes decades wan unf imper depending "
    "policies andy italian signs bot publish iral recognized lind ection relatively icket specifically nost grass causes utter festival greg weapons "
    "virginia login schedul losing europ asp ajo exports jako successfully friendly pregn binary isting stared circumstances rei cnt analy marg alleg "
    "selling seriously textit chip candidate eria britain barely sty spanish timer documents contro protocol evolution posted behavi ipping dynam scheme "
    "collections riev uns widetilde remembered inates incorpor prepare uation queen automatically sharp meat ateur astern stuck planned dots ookie reviews "
    "answered sau mexico apple identified mol islam committed rift interrupt readonly aza inline tent aki lady tired ifi ouver aside bringing drawing aro "
    "naz esso reaction mitted absolute haust tone wheel administration interests encounter aver ket beach enjoyed squad zel medium sending destination nych "
    "conflict vul basically reated ugins calm dump acher claimed blind enti tough gebra sept hew skill tay pare fee continues ovo icture shire essay "
    "suppose etic acon lla comparison challenges citep papers quer thur shock dedicated correspond bull indent figures andrew isp favour nearby ications "
    "perspective nos apa icer plastic ciples plugin funds indu drawn developing segment isme lies scal gentle canadian articles leur stom stead ipher prze "
    "draft stayed vot fabric rea reput assertequals ursday audio gap streets scientific auss choices heads terday nick weird asant represented arters oga "
    "owned hdr uable neighborhood resulting shadow videos valley sher frastr operating licensed hans clone gesch uing hundreds emotional egypt fasc adam "
    "laid rig detailed implements regions slot angry waited elem owed ratio isen gery cream angers governing jest icious emphas umps sul historical ija "
    "steve measures osto pocket pitch natur humans simon adores inking expos apparently camb spaces acting ienne williams fruit iera trait artists absor "
    "rait movies dynamic asts smoke angel instrument fuel atalogue bathroom ilo esto entials tips capable bitr mapping tak karl represents consistent wen "
    "begins mountain wondered industrial directed eros liament username bra sharing uesday ylv guitar elen confident rypto hors shoulders getname encing "
    "kinds purposes owners chat dor redit oire bread compre shoes nej orted procedure plier hero marked worried pts serving disappoint scot pleasure judge "
    "zeich forever zeit uous inent waren flash troops drugs diam inned justice officials ffff tomorrow texture qpoint fried pgfqpoint nem hardly oda zeta "
    "emic loaded kes fool trick merely edward rif crisis finite lol kim ibilities ibli sympt oral ders otte jane originally throat uni attacks ingen coin "
    "ounce academy isms incident bij italy fern silent plain pill rase carrying resp typical wrapper gau chemical gab quir relief frustr stores bottle lew "
    "cheek concerns helpful coverage isi approximately iffer evil constantly practices teachers awards substant mob ingred vere stal yard vement "
    "intelligence thinks personally trained orney gged einval arna hamilton merce ekt rug survey nesday pag boundary quantum volunte swim revealed explan "
    "gotten falling contained killing aspects icted tion iran beit ssion mah resolution boss chor debt gie uno plom kenn finns somewhat probability chart "
    "stands tabular boost desper alert suite vacc thursday proved moral auer codec instant amps milk forma columb oret frequency irement assumed smell aqu "
    "oor inity resolve tears bother registered revolution versions ydro dub noch charges arios uar elve manifest attached spiritual alexander unes seed "
    "magazine eigen swing asia identifier alcohol styles assertequal millions chunk aaaa launched wake guests differences udi ulator execute ching beer "
    "yards technique atten hoping victory itat significantly practical ije expansion ixels extent lio pued olid gam sevent anguages asty rieg gio colle "
    "stored istant lip illo mehr interior adel shopping dition raham brings propag ityengine ireland harr eno tok omorph affected degrees nin interaction "
    "tuesday iterator scatter ucket duty answers eed vie depos packet tow deleg vary migr esa haus portug ilation frequently oche rez viet quis charged "
    "accurate keit eras derived aje uren ureau aland execution eden seeking trem geme inating columns injury endent headed muslim climate fake fection pit "
    "embed strings proc trl agraph iest goods batch optional taylor recognize elizabeth careful locations structures disk ships suo sowie reasonable "
    "moreover formula residents trib stable breaking meal phen fel fred capture opts everywhere sque moder whenever wart toe hou gage frag theorem contents "
    "docs irish aats agency cancel superior literature basket fetch stadt conj seiner confirmed argent amar pgfpath struggle itan moon orough catholic "
    "struck weapon subst instructions occas contra deck ignored refused criminal olly immediate assigned elected tonight preced galax logic enza captain "
    "hay facts oped combat explore loader wilson locked disabled hatte shout constructor tras adj carolina atore exhaust delivered referred prospect scan "
    "modified generator excess zet icz clipse tank guns inton wednesday mainly effectively resident flying mayor uta colour aircraft terior keeps shirt "
    "slice czy gender butter dma registry classic drove reward yal hyper entries kingdom prompt centering holly eman painting idades rein rical sab resc "
    "patterns arraylist aco hasta installed atie visited desde drew obby izable ogether aber alis expressed supports commune prince dels neur recommended "
    "founded markets destroyed abstract serie dun portion isset returning enties usb igate settled nek therm cig investigation ometer retail drinking "
    "iginal assistance intellect leon admit illes rov matching genu notation nap verify aussi datetime suitable indicate tracks hasn closely ceive agy awn "
    "stell pton limits moves oker scribe elijk constants channels riority trading facilities estimate guest nobody twitter darkness jpg kernel extend roc "
    "burst repair ieg blem appcompat chap penn promote ukr arest samples greek constru universe elijke preferred dow agues experts pio distingu seine eping "
    "fairly ixer insi authors edges shooting maps chant covid linked ske powers stomach usage defend sustain updates assign discipl bunch obama nis agents "
    "chter glanced jam ogram formance vit harder desired jug supporting ucky issued affili partners cdots ctic priority declared browser grande accommod "
    "suffering breakfast uli contribution semble housing essa inson entes apsed broadcast tar delight chester emergency nership situations familjen enta "
    "fundamental academic rising braz receiving judg necessarily deeply gray coal bach profit igs ograp advoc agric arrang flowers umerate ihr widehat besk "
    "curve cleaning regional estimated arity ierung jango threw nergy awesome unnel foreach uate frastructure routine horses requested lifted myst proxy "
    "hemat ului improved ieren ocolate unic professor ieler duration lux trab itary inspired isely ials enhance lucky elo ifiers facing appreciate bench "
    "atted gence tub lors mistake paus subs stato gay orry vehicles brill wore onel diagn mathsf holiday achieved ctr ishop occurs straint nuclear "
    "surrounding juan prima southern itty assembly adi gegen tony pressed anne pak thrown pump solve ktet validate negoti anno sans edition spectrum orie "
    "cow istribution readers consumer encode visitors udad qquad trop yesterday tain atro increases wars ned aupt dalla strike recovery strategies rear "
    "adults olen jord kal cui peut arten entertain parking erre funding unst cancell feedback pand mirror verb highlight erialize brook implies enorm "
    "machines dent tid mole bold cutting tong networks uest belg sheet victor candidates etr arthur zes inners fired ichen vertex aja hence executive "
    "liquid uje driven igue wik rand copies tan riteria enen pobl eln zwei concrete dreams minim employee suspect mouse therapy aval anth sters ishment "
    "mood shr decade arry jquery corporate appointed embar ographie champion emit gui urban sentence bury regularly ockey evin ultural passage largely "
    "orters connections surprising strongly ansas sist extreme whel dealing ographic republican granted lessly upload valuable issance iens heit suggests "
    "jur invited deriv rass instruct courses fifty catalogue tensor stephen consists normally ubl padding eres puts uminate ovie giant pson victim attended "
    "maintenance bean ilarly convent udd poly asks enthus suck corporation usions opher symptoms johann earing furniture lovely alg edly finds fox cock "
    "bundle puis announce guid icide gil schen ologist iso somebody compact organized roles hint pays hoped sail embr exceed gaze spons torch newspaper "
    "bass hanging getvalue unus dressed lav sections errorf inz metric vice nue revs collected oose nas abuse sees exec arbitr magnetic newly reprodu "
    "writers jews labels socket equations medicine authorities corn environmental pacific uncertain belief tobe weet featured touched tact pository eines "
    "lass przez fuer exciting cub agan ubble kong versch naar territor jahre crossed stim ursor notnull albert signature idas decent faced spain resistance "
    "brian kwargs interval explo semi widely kov knife lineto bund tags guarantee vital fought anticip mediate proven partir cursor wooden regs provinc "
    "memories battery utenant ountry compens operatorname jacob zed coat fir michel coeff iraq peu parallel cio kow institutions aban sarah atmos brothers "
    "wanting fest forty creates anches xis ntil leaned unda ultimately neh lawyer hend facility likes ento entrance atto rett osi pgfpathlineto innoc "
    "proport arrive pairs wrapped unw explos zealand legit illegal tort pron forg discount poster ented sto bible pending strap ieron cular urd northern "
    "naturally weg drunk continuous initially agu recording correctly debate permit professionals handed beskrevs anxiety heavily dispos izon operators "
    "nego bry votes izione feat confront stronger nad checking birds intention uce covers wondering aggress quot bom navy everybody unexpected divor ease "
    "umbled cuss pale inga pens principle letting conducted measured democratic ennes indicates encourage holy efficiency tle diverse wallet earned wol ifs "
    "atin fees pleased suffered participants legend handling git usters clude tap assets blev sleeping warranty eries domestic eric bie searching "
    "underarter izar approved oned compute ridic igd conclusion controlled rieve birthday advertising ussian ionale resid informed kter documentation brad "
    "regardless statements plications attitude pipe whispered privacy persons iences paths onymous pap worker pink inar archy donde loose reputation lesh "
    "tober omy comprehens transformation fallen marie umi hong sink feder quel temps ghost erchant aha ulf supplement dismiss closing vulner overwhel disag "
    "acia oured ruption endpoint stairs lyn eleg veter lung yours ailability joke annoy rag ilty cual solar taxes estyle facil sought bare jar crucial kent "
    "bike admitted spell vic theless acceler convin pra slip gang asted uals dying ammen erchantability dick layers tied alors jou chicken permanent peak "
    "dear introduce causing hund annt breat commitment increasingly statistics plicate aci ceo ifting imiento getelement wieder instruction gly blame "
    "listade aapt lewis fragment gear prod burning complicated tested staring survive cous aml cad twelve grant thorough folks childhood cker finale shower "
    "spat odge eda antonio engaged vess vals electronic lemma merge apon privile novembre controls categories georgia ipedia atori ryan charlie emotion "
    "cooking attempts fitness aspnet ordinary avait upp illness zwischen hardware sounded equiv piano uset bab reliable bronnen lij eva syd inois declare "
    "bres itled accord mars zip brazil meetings accuracy autor ainsi bang eing ateful upset dimensional explanation civ conce promised abb clothing oen "
    "sizes banks ribed hug instances alongside renew waves pom grabbed surgery restore leb analyt literal shares illet ols orno manip jav essentially "
    "casual opl engineering reaching kre erry oppon emper isempty ethe ropol owy myth ceptions worden assault dual inches personality scar regime noten "
    "rural iza disput obst utf cass hspace shipping iko icked riel opol classical constructed referenties captured minimal sock equally reduction aison "
    "argue toler primarily usal algebra gathered recipe scenario temporary consequences displ apps teil adopted femin tech knees owej oxford ografia "
    "exposed ktop oby senate sword unfortunately boxes cuando pilot desert rons adows loyal asset mud secondary asian staying dataset loves velocity "
    "purchased competitive iska knock azy vend bras uela trim dirty websites indep ticket atile implemented bowl alter accompan ordon doctors istas urers "
    "ingredients calculated leather sensitive suspic anni abort walter unkt vertical itated diplom orne bars pons utz stir primer igible bos welt korea "
    "vibr deeper termin enschaft ammed ioexception usqu apture ashboard divided extensive suffer heading quietly ikan designs acji servlet kevin textwidth "
    "enem unde ked synt moh dave succ toggle tack eron awareness contemporary ulating havior dozen cheese coln radius dimensions roduction adds household "
    "davis pkg casino pierre objective michigan payload severe toss embarrass appeal forgotten carbon empire quote etz mini nous nervous bush peer "
    "satisfied pulling miller mile supplies victoria agnostic viv patrick aca mountains settlement furthermore drivers impression infer olute ovan arance "
    "enforce iate cried junit issa begun visiting targets latin diagram partnership ulty modal itzer itel convinced abl cot repeat lists grace oraz "
    "notification prite arrival ancell hentic decode fantastic kel convenient aque riet iors budd andra addy overs consumers heast atmosphere gig contre "
    "drama philosophy hart nurs uras tru performing confused checks amt izations degli architecture renderer dieser submit topics principles vars tongue "
    "percentage dol rice eastern recognition caut conversion ohio surely gard imi absence winner emotions flu operate unning partie golden isten carlos "
    "neighb scheduled observations producer athers expectations oso mutable writes pushing seats breast aping slave iley assistant landscape palest sweat "
    "engers curious replacement peror calculate sessions typed partition eding azioni onal shru cand gov asa particles tube eland ogo approaches onda agr "
    "lud casa fifteen potentially seit animation elif acknowled ownership describes reverse contest scored opposed covering honestly rarely incredible "
    "itage victims izza onde przy displayed ocean avenue acion ghan ieties attractive verter alice fraction behaviour jersey revenue tres wich ancest omo "
    "gained momentum ieu ielt bonus languages representing curr contributions electron achel secretary jahrhund threshold bage concer bone hollywood "
    "awarded aggio flesh ington aser quart ryption ften operand indicated getstring spir vens foods anza notion employment nbsp pounds participate apol "
    "fost publication rapidly wis eventlistener uso merchantability experiments naj interact cms roger outcome hits spark verw agnostics soci dining folio "
    "ultane pros posit aspnetcore coinc references cada jordan gep andidate amo deutsch auc surrounded nome underlying educational inch umph mechanism "
    "eness acquired falls curs riers marks energ hof ylvania allen umpy engage mant orse improvement arrested itched cycl neutral jess dip opposition "
    "borrow avant gall rgb guilty buried accomp breathing berry subsequent roupe ulpt argv svg oup precisely rena folder revol reddit adelph discrim pleted "
    "gently ropy dial notfound onte relie ounced grave recip naam directions lincoln unci neq tum saving aille itemize msm ffer territory kat ocker sne "
    "fails introduction ycle vier kle advis gym protein providers soil reation ensis inas scotland dispatch bere studying ssl fright compr madrid rowned "
    "opes pdev wash accum rolling fiction ipt lap whereas appointment nah validation icons radical exclusive emony challenging vida campus plaat bst "
    "intense ltd controvers landing scenes spoken pride quet meter uum bless hann inputs withdraw acles airport columbia chocolate alarm ftware jay sake "
    "registration hack indexof clubs primera brilliant uther difficulty itals scores aska acid aton atomic freq reporting nights programme xic spo lined "
    "quarters eree mers serves enso environ crash kap noindent infrastructure orer atherine sydney gauge bably commonly stations iah eten iac amos nement "
    "cabin shots singing accessible ancial canvas addresses zing atern choosing burned brid kern dish hind jahren allas billy usammen itud geon ittel addle "
    "muscle scared sson denote ieurs orange hub reb edi voices suspend scrap aggreg riding breed concert approx chances scholar offs flush soort functional "
    "bou subjects mys extraord ikt iami itionally athlet heaven experimental bounds excit quit universal stub bart coc eted possess unusual bags loading "
    "pletion paused counsel zech tie armed observe permet eggs incredibly werken izard painted vietnam violent ierra weise josh ashes niet involves organis "
    "nacional bara depuis disney restaurants baseball algun employed unityengine integration risks stro agosto stroke deals ajax adelphia screw inev donald "
    "cca esis separated dbg packed monte province expanded approached impressive shame unwrap shouted maur unque uego zem dutch herm stretch vard tries "
    "disappeared crusher cambridge dopo atura spiel atting wig codes powder sembl roots holl constitu ificial closure figured assumption getelementbyid "
    "oses epper obre enumerate lessons qualified anse sylvania binding reminded membership iper zte cref plaatst phrase rivial pse tournament elson refuge "
    "elsewhere abandoned ibil platz flour laughing wales cake crate anga amounts ometric constraints temple installation neder ibid jusqu ikes nak modes "
    "hitler belt pointing persu besides ynom legis anded uis bsite euro eclipse irre meanwhile familie jason ciudad technologies nica evident aman supreme "
    "atoes steady monthly applying minds kam expertise deliber resist outes howard presentation youtube rust nations responses arded immer reveal todos "
    "ategories payments enumer platforms lifetime enders cum pler appl enez overty ynchron argued kath synchron rieb usk jumped contribute mesh rell polar "
    "trois icio gaz fifth lisher involving sull kate interactions toronto difer liberal particle surve alous depression flower waar hade centuries uty "
    "approval barn monde clark theoret viously rud stmt inction tun roads rotation ppen sensor kol idelines composed virus lar opinions uction rupal "
    "underline horror otto statist gem secre strip dirt discovery substantial ibt demands everyday besch roit timestamp bulk retval nung talks scientists "
    "vig quantity movements lings rito ilst happiness leaf assessment irs attorney anthony amiento circul frances pent mate owo istes tran sons investors "
    "philipp thod panic detection simultane nte listened brig abund criteria mining mates worship router cole downt holes grateful europa consent opter "
    "colleagues orous enemies fluid scratch cers ribu completion rient explains anybody lon ocal morgan sang passes ijd bast entertainment hin grat minn "
    "printed franklin manufacturing rely conse fishing clinical evaluation attacked frozen zent rational othe settext alc hydro theatre attrs mie offices "
    "decay unted usc marzo asleep soldier contrad wins ceiver seasons healthcare worldwide responded procedures cleared omin deploy ongoing bones shrugged "
    "initialize ted mage hire tracking ceiling etti courage enschapp folg kelly reven disp defeat creature kennedy diego steam endance ignor emen proposal "
    "weiter ibles consideration believes soph matthew circuit singer representative comprehensive liga mere tbl continuing ographer sear enormous izi "
    "guerra lesson zon researchers attempted enf defin awful lowest unlike producing faire maxim assemb acent plica stages tang dependent lifer ascript "
    "exposure barcel xspace prest urce observation commands eager outdoor puzz kennis regarded fois optimal subscription imental legisl branches veg sprint "
    "flux freder sis notify nym ingham shield luke unsafe telephone snd suiv entering quando fed alan mathscr pregnant ersten alia retired erh composition "
    "gpu permitted agencies klik rating pennsylvania dumb creek golf gpio cls parliament sep badly igi gemeinde uart itempty niger immigr istribute helpers "
    "waters joining omitempty redd converted prayer elections erie iembre holders utschen tery narrative minus wand wished icode orr detected municipal "
    "citet grey voy lleg currency strument expecting tickets bucket egr jacket drv loans kann integral characteristics manual dynamics sha reens onical "
    "toile distant handled penal prominent exped achuset bild entitled jag rejected memor orts applies achusetts rocks smiling efter bands collaboration "
    "glas engagement wings netje ativa duke dove yers evaluate odigd onomy illinois coordinates pisode ucked flav brands calendar uitgen tale briefly "
    "integrated cookies uitgenodigd phenomen voegen refers clinton assignment inals asym anderson rique behalf breaks soap crying boots owing bundes ndef "
    "floating roce raj bewerken cen pakistan greatly logging opens klikken sculpt apore nich nan injured tha commander receiver hopes byl getid feld "
    "executed inhab glob geplaatst beginnetje kur aligned certificate soll pandemic gree roughly specify mapper licht thumb unlikely edd hey periods titles "
    "fon onds fal gth itudes destruction stake ifferent identical fog jax historic entrepre tension philadelphia frames muy resolved tape singular "
    "personnel scalar cable jenn erst struggling dvd throwing satisfy colorado slipped poison ultimate flick raising transactions glance gri endl "
    "maintained encouraged essere hired itches woj injuries dil peat apolog regulations presents poetry stops tol tower organic drei pound worn parad fic "
    "jimmy minist vspace lighting naked designer resentation measurement muscles fru genre retirement gon healing sido incipal gordon wiki concerning "
    "rizona arranged bpack ipp colleg explicitly irus redistribute uerto elder grounds signals gifts strengthen finance noc helm cuts adventure "
    "intellectual awk concentration guidance filling regul delicious lob rush attice pok lid dna ladies rescue avity glasses bey favourite precision conoc "
    "inputstream orp picking iph priest pist bil conservative eval iking sauce assen occasionally drum gettype strategic corps considerable tous clar poem "
    "traveling ferr pharm abi measurements utsche demanded accompanied prend encoding geschichte mig gib myster physically bau managing iri tant fot "
    "nullable guards chamber bias tai insic bent prohib fewer lugar deserve reck stability resize assertthat plugins laura brut isons dyn icher rayed "
    "frequent jedoch marine portugal insight requirement emplates ceremony physics graduate preserv shops zek fib hogy bourne emerged ighth drinks iev "
    "ployee instantly obi justify nev agra transmission symbols jail craw lifestyle redirect osc insisted jaw inda knee hello defeated mixture encer "
    "suicide ologia deaths listing processed omer tokens giorn elabor massachusetts schw asting tiene dirig transferred odi hunting enjoying losses loving "
    "inspect avia hated brush uncomfort communicate programming inely consumption erial communications iere alfred prost fier bbc featuring arte premium "
    "zig deze afghan hythm anco gorithms sighed reads automatic medal mik liver atlantic omi assuming aler undert flew kaz tiem attach safely tempt atta "
    "ebook eerst reson accused basketball perf tempo logo incorrect girlfriend nar clouds fits pear ampl icking realiz nier sistema getinstance beliefs "
    "irrit ensitive nouve meals closest routes fulfill cout inequ pelo shortly imagined unden trusted estimates issenschaft logical compass rang trap "
    "inject pection satisfaction robust charlotte itative inspiration orious eurs analog alias racing ustral uuid emente groupname yout rab nell preparing "
    "concluded pars loro gut bitter weekly tear demonstrate rus obsc lawrence consciousness races mismo occupied slide tcp stiff leben upgrade puede visor "
    "alber mbol romantic corresponds infinite argentina wip uspend judgment usted crement fert emperature dall rival conform additionally exclus gods "
    "unidos concepts mild supplied capabilities marry snapshot etwa ktion grip samuel beck gallery richt peg amment faint plug iele cov encuent abc clud "
    "symmetry ailing moore shifted damaged testim hiding horn pixels confusion etta rypted emat cluding lookup allem atio metry idays assass beam pela "
    "indones ukraine jonathan governor imeter krist affordable unto cargo bruce ohl menuitem dawn wisdom decimal fet dens filed harris resolver complement "
    "pref intens garage aient etern denied ridiculous atti questo determin arbitrary ilia clusion addressed interpretation pants taghelper submitted ilib "
    "chell haupt heid cord poverty amped estados validator atom lope tile preparation woods chef improving metrics blink actors survived rachel deutscher "
    "sop vil promotion classification alen cort quate concat officially bernard usr landed ulum porn tard ggreg intensity zza excuse generations ouses "
    "warned capit chop omed prosecut retain agine werk itutional instinct boundaries median horrible innovative vacation walks recalled barcelona olas "
    "legislation franch differently imagination bills reception imported illon balls institution survival flavor computed viewed swimming innovation "
    "rollers serge filters itivity mathemat labour punt revers nowhere rific monitoring stabil acco oric pipeline radi ulus celebrate agonal houston beings "
    "vous wetenschapp turk culate ventory insect velt encore dude lapt fen prot seva miami matched encil diese uggest ubern emily fate esty luis existed "
    "expressions iddleware literary remarkable resulted spots urations ongo genuine sorts expenses singles ografie swer riving anas gles operated owski "
    "rium infect italia dollar buttons participation bio straints ourt precise hascolumn neighbors democrats azure irtschaft cousin createelement capac "
    "pause kte shaking reducing voting ministry accompany ulle equipped nun engines locale alien iji versus kor emission umm ycz climbed plusieurs yar "
    "osten crossing polynom removal adams ihre anden benj phill wounded castle processor tin mexican administrative conqu cheer juni encontr avi aku "
    "smoking attered balt defer pathy sisters revel itos removing herr cra farmers overcome igkeit criptions shake placement episodes bullet viene biologie "
    "usestate iani speaker refr cultiv hungry excitement ibraries inery velope porter climb eli urent mistakes pkt sted ublice shapes innen ibe margaret "
    "gene disturb onclick stopping restrictions shadows hci christians fence luxury akh investigate conventional visits reflected wolf rente simulation "
    "esota theories collective coordinate queryselector emed gef electricity gathering aters roma cooper iversary aines independence woh consequence "
    "conversations andere moist rode perd szer flood intim stderr reflection disaster akespe humor friedrich suggestions uvud glied fas sdk seus arizona "
    "innocent acious moscow caps delegate dramatic shore uki russell correlation pubblic zym ferm affairs pixel dancing agreements ancia ationtoken carter "
    "outstanding barbara nurse douglas nucle ouri avo painful slic seinem ogene satell tagon collapse velle aughters threatened desperate conflic atos "
    "theater pleasant singapore heet pir acquis recru respective tunnel dean uncle offensive colo stones iphone fantasy korean halten kay requency duties "
    "awt nearest disorder chile transportation dez iju ivel chin voted sue legacy itis snap impressed deposit divid crimes insult bounded kicked awkward "
    "beim placeholder spi ientes blk neo itarian cogn sout trash decline tat combine drops cheduler governments nag rtc performances rupted managers pitt "
    "mystery settle ulse asha urable backup seinen vulnerable friendship rifice involve corrid inequality hex wider glen initely ihood waist manchester "
    "masses chairs citt seeds democracy dto harvard sid fers spare groupe sender christopher prisoners crist susan juli diab ixon icator flexible reserve "
    "hil towns grund criticism politician idal terminal complexity locally pole equality isinstance ippi mater slaves usalem haz wrest llam ushes virtually "
    "weights llvm cave ellt ifact vendor emma geometry referee weit fica iona dagger januar isterschaft ppo oids shader constraint peters eyeb cookie bye "
    "savings python patri multip kinda franz cloth fleet humanity resa blob buch lond murm linewidth especial hosp tanto oldest roose hitting ovi "
    "compatible poch accomplish geld icia lum janvier divorce scottish ruppe refuse oktober ijk amy dimin gross trat isible mixer autres neat otros schol "
    "walker ologists haben uber attendance blade oplus manufacturer asz rer succeeded uffle backed esian xix hearts olu fraud edu gaming plt igator "
    "compiler monument agem moins oku osex kansas gepublice rices juin uncomfortable obb strcmp dread rition demonstrated vertices dictionary trm examine "
    "therap produces photographs threads extraordinary gepubliceerd poland guaranteed errno iffs tam beth translate belongs electrical ensk presum "
    "approximation grim ution owych sterreich characteristic oming prize minnesota indices stem regon salv internation resume akespeare estado brow nfl "
    "trends austin folk nest junior maintaining bloody dtype pane bacter gradually indicating decrease tek developers retr navigation esi lazy assured "
    "andre fang industries incon retriev eni turkey izers palm grin tiempo prix deput sixt predicted ihm manus apos instruments counts aimed dok estud iesz "
    "piss inaug voters packages cute leurs sorted phant emi tooth upcoming graham precious agle aris pile routing oliver ifndef etzt skiego alled "
    "temperatures erna lun streaming oak cli lucy calculation mul outcomes centers residence preserve peon uffix roberts promot courts disg elfare retreat "
    "dio bez roosevelt coupling marshall railway bureau possibilities mero mund lette summar describing liest verd galaxies pyobject organisation ocom bite "
    "seattle observer morph urches alph reement consin dann cats brew circles drift agma valent surviv alin uncertainty engineer icular orest horizontal "
    "utc textrm germans uti numerical reass cod ensing addclass simultaneously harsh precated adget findings ivan possession parsed riors zeichnet enables "
    "orientation indians gary isan comun coron boyfriend diagnostics eft unct annon enthusi whit aude disagree snapped sour ugar infection feb chts swap "
    "interviews laughter gra zens getmessage mortgage multicol declar ligger carm vegas eug orus brick hascolumntype licher attan comparator authentic "
    "monster transformed firms catalog boards diseases benjamin horizon mvc cabinet testcase ansk ierten vocal halt alexand colomb ivamente artificial "
    "atlanta mentre estaba jekt slept endless attery uur weakness attempting founder schwe raction compound conve caf handful onne defensive alignment "
    "significance arta perpet caller icients cep stolen focusing bree occasions issement actress jej twisted nicol brasil juice alb softly mck gren "
    "italiano creatures residential instagram ucks killer johnny enterprise chestra tel oust vacuum defect ninete fare regret shar ctrine icit oka "
    "provision discussions abd ieve olving wohner guidelines straw burden spatial stretched typedef pliers mcg arette subsequently honey "
    "establishment tesy islands cken variation azor tuple gravity conclude ethnic compile parl paragraph posite oba pedro fis odox posting racial dishes "
    "asserttrue slid juillet runner colonel curves primo ockets multicolumn hunter othy famille fueron headquarters dign robin meets soit theoretical "
    "plicity camps helen amplit memorial undial lieutenant jefferson servers lyph computers protagon forehead unis signing downtown elihood algorithms hamb "
    "cust mounted paren isolated orbit printk turb grupo hills estone satisfying associate distract barrel invariant lieu ontario zial compete couples sei "
    "migration acked neighbour fte odds optimization voir politicians khan shelter timing septembre couch ultur giov liegt carpet abling inth pursue "
    "constitution anj fbi phones knocked decom iek venez pupp bian cotton acceptable cussion rounds actively amongst popup diversity usz employer specially "
    "suspected crypt oscar babies mundo libert ahren magnitude gust grain toequal consistently dominant converter atable scriptions substance ussen coins "
    "nelson exempl chg synd verted avier convention gling hora whilst serialize danny reaches eligible cameras discipline silly rets ytics referring merch "
    "olves emet cke rios susp exhibition extensions keeper jake footer realm contributed hid metres achelor onders advantages iov sheets cembre subseteq "
    "blocked panels nde meters rapport jak pup relaxed idding defines kissed invasion screens passengers ationship beating liferay gabriel ivot rental "
    "shocked kommun anka cape trag hosted ysk elligence nevertheless bitro holm quiry mechanical aneous psychological abroad avoir separation hawai iejsc "
    "nether subtle marker hover soup chr pci ientras availability opera iane morris sib fiber ningen zej avan syst spite toxic apro trips plaats convey oko "
    "lobby recommendations overwhelming ennessee acquire lobal recur ommen jog nast wishes nancy supporters disappointed lint islamic endment digest "
    "aggressive intelligent sterdam overflow imb ceptor yields sebast utility faculty attracted mixing ruth escaped drain rings quire convince orsch rage "
    "pig catal gorge dependence cruel thermal utdown refresh resort pregnancy projection themes funeral caso tissue dragon nei comedy passenger ygon "
    "villages lisa diver translated abama regia tta jamie punch tainment krieg restricted grandmother sinc optical lane deutschland saison pez owany dallas "
    "anchor encias reporter vegetables enforcement wisconsin condem sits calculations uelle tipo phan konnte zap engu perturb agog estly warren flip iop "
    "keyboard isto promoted backs gmin followers pepper umble spray drives geldig igung attribut uru maar jections renov finity pgfset hypothes macro ucht "
    "horm hosting lattice portfolio ielen subscribe footnote momento dich entert connecting racist penalty israeli descend belly encountered guilt damp "
    "zeug shakespeare woke salary etheless erde hein geben ieval octobre janu jerry kehr contracts affair dropping dic finland dort kings similarly verm "
    "pretend csv dialogue publicly wedge hoch speaks compensation anca texttt partly useless deter consecut graduated andal austria orden notable "
    "journalist clay ivi scales erste datatype reluct ienst astro actly daughters manufacturers printing ndex brows notations atel meaningful ueto familia "
    "steep presidential afterwards halb struggled userid acular ivia ugly kunst qstring griff rale memcpy mississ huvud eca jahrhundert grandfather oregon "
    "gue xygen habits lowered radiation aben costa devoted gesture dezember quoted difficulties sustainable dense ihrer firmly oment poi django profound "
    "wilhelm avril propose ranks mutual texts quasi nog nouveau noble clever sag ictions nant jacques finn devast fluct sciences shorter suggestion ateurs "
    "rounded tart uper secrets companion bibli erness prediction olare rpc tens enas portal forme stag marx llc dare olympic pant cops rushed initiative "
    "invite habitants ensen quatre eve pendant configure rifle declaration illery ospel arena purple pills uetooth lique populations accent ranges rection "
    "visitor identification bootstrap surfaces screaming jazz rika vre newspapers ihn strictly recovered expense donc sacrifice travers curios escal pentru "
    "beste visibility abul authentication lod xfc jsce harmony zich julia edited affe syntax yll lucas anderen spectral assador importante stere melt "
    "itutes satisfies tomb solely tennis sigh serde uba lez squeez thompson finishing lover lesser pond paintings assumptions modification toilet rar sheep "
    "actic yrics backward realistic azi xfe fancy laser comic ounters melbourne omot asticsearch editing oples glise helic stranger inian complain "
    "increment mma engaging uler lens barrier cups iterr izio sweden athon esk nea improvements indiana hosts parker espa avis emphasis olv recurs itaire "
    "bishop nero deny doub peonato queens blur eled izo anxious stare proposition arrangement boats slots appearing etto zenia variations whites glo icky "
    "jury treatments profiles conspir classroom lawyers vue sla attending bored ptic appar pont jerk hedral handles afghanistan boring ifik shade airo oday "
    "plates championships cheeks rike eddie sod trains ubre inherit cours makeup regex detroit piet aceae anya backend tennessee picker leo prises mature "
    "moy baker stanley eleven olate fortune statuscode entities anos ordering strlen rope cigarette irable valueof photography estra cultures mercial lied "
    "aute rhythm nih intersection mog threats apor sigu setminus shed francia lowercase befind czech wes larry emails padre acio genetic acceptance wheels "
    "thoroughly unction ugs ientos politique campaigns tokyo albums pdata laptop fou orb corners pless specialist namely scaling centro omorphism contrary "
    "striking forecast zones ashi rin simulations assh failing manif bog influenced weigh inventory apare iom proportion approaching inhabit traveled nex "
    "offense incent coefficients sooner eze maker ranked fulness partially cached balanced ahoma murray ivos bark kirche allocated cens acz filip trials "
    "nika exem advers umped arding keen bitch embedded rides hashmap counting verein cid hunt cies swift temporada environments claimer emetery bew harvest "
    "mak ieri determination emerging oly bah istrz shan bronze fitting mgr uter contacts firing profes ruled andro ensuring izen isecond obil bitmap brun "
    "jerusalem republicans matic earl dock mall latach segments refund recycl imperial practically ierno edes bahn catherine highway unting liste retrieve "
    "dominated asures tls accomplished fears seemingly dag accordance oux colonial compassion swo workshop lub generous rous avid igenous javascript "
    "garbage fatal transparent bearing celebrated convenience mattress invisible claiming robinson notamment surf acknowledge lawn bases exceptional abei "
    "quien mare bullshit dragged abet cyl uzione karen sembled dose suggesting imir plac arrangements illuminate cido mysql alion idle hud ellschaft fucked "
    "oline repeatedly heating steven enomem maryland dup stacktrace pus modo tanks elite targeted newton dried fixture profits dispar intervention "
    "functionality tere borg wrist getattribute acions guerre novels triumph chiat scoring absent replacing neath embrace overse carrier arono cery ilor "
    "poco cheaper sophistic tera polish varied rott freak bust alabama nten umen neuro definitions forming iolet nederland musik bidden classe bottles "
    "denly gos titre straightforward asets opponent generating ulu patron rodr probe henri annotations ucker eee grows acre acted niej planes chronic "
    "apolis washing oning barry spirits recruit muj rah cruz explaining gouver vincent gpl punishment nels ktr upt wright vectors banned touching "
    "serializer hattan barr divine aest erves mack greece circular inden alling mascul designated breathe oard involvement publishing rubber pint "
    "mississippi evt progressive bourg zusammen sean battles pires massage tob adjacent imore aaron lua integrity jas kfree chains stunning ools idges "
    "poder clusters madison forcing bobby poured stellung mint nathan thor wherever stair blend inks rav feeding netherlands netic metic lis protecting "
    "nova volumes lage galaxy hba eliminate ucc vlad eny sufficiently tremend kos critics representatives havia mens ubernetes mario bia aims hpp urchase "
    "newcommand grief categor educated unh elegant ollar isti abril accounting predictions ienen charity arroll thrust tender saud pcm missouri inflation "
    "sched joan waved departure sprintf promises hopefully reib unmar folded placing discussing occasional palace autre passionate citizen swept popularity "
    "acres certified dao mans nelle ieden outputstream anqu poon utiliz setattribute distinction overhead stewart codegen transmit indirect bek nursing "
    "gambling gres doorway lle tren dere praise emperor crystal hammer insights apis iowa aty wealthy pizza arently rera crc eyed restart jewel oser sixty "
    "issen worlds haul celebration popula twist rile ifica stark ligt glory phenomenon agenda quotes campbell manuel churches analyze expanding steal egu "
    "affects distributions trunk eran ulp omon encoder vocals presc icus gebiet propriet ampa skilled qualities leans apest dre executioncontext pragma "
    "causa prosper localhost claire burgh vik gettext coup osexual volunteers adesh liverpool augment ingo sized tib dys fled strain nitt ichten ulative "
    "tym substring investments ielle exercises medication holmes posterior sixth trapped manuscript ismus speakers climbing awake volta habitat stata mold "
    "abad embargo nash exhausted sbur grandes tommy pressing ocup iances addeventlistener slope moz adora gol consisting eisen artistic inta magical immune "
    "anon defaults exceptions farther ativo teenth toy stor isson celui venne copa legitimate unem spotted unused disco miguel alliance perception "
    "amsterdam inale streams holidays examination mitglied whist sends vii pulse sulla uniqu displays announcement oton scattered aky experiencing chrome "
    "leveland kers heeft chaos bail aston franchise advised stain xxx shaped symmetric ateral taient foss bereits amic nba ligne appings serialization "
    "malays oxygen underground wage eton crypto ttes oscill marco males mitchell oenix ritual sacred vessel angled spector conservation ensures ilibrium "
    "fprintf tti chs anniversary iggers durant venture fitz cbd backing edish giovanni recipes bigg minority ollary reduces itas examined gradient vien "
    "beds anson intu flows affection repo ailand intage lamp beneficial fitted verk focuses vod carlo ainted rape togg acker jealous remarks skull rien "
    "switched beef appearances collins villa zona neu operational hockey nuts leaning essence nazi worthy onie knight peaceful silk pione tolowercase buzz "
    "washed itzerland ramp kun vaccine justin memset census statistical tropical craig magaz computing floors oine titolo anci metall isabel carries tpl "
    "perp ehicle lut dull thereby ipv insane mysterious uchar asma nett derive murdered akten volunteer erta imgui reactions purchasing embod altogether "
    "promoting induced eerste hdd chill dirname tune februar suspended eri preter hiring olympics dale exploring universities sony thal escrit corruption "
    "azar neb chim capability retry terry viewbyid vine biden glich ratings executor ibration heal ifiable pete traged chuck wireless junto taghelpers "
    "comparing celle obtaining quar inea princess ijo gens receives iken nail iece ifference bubble demanding credentials structural wayne blanket repet "
    "exclusively arguing repub frowned skim releases tast preference activate clam crushing walt lagen coaching ighters basement commons ully hbox otype "
    "troubles arsi denotes importantly relating grinned dak brooklyn schul trailer erek counted vamp relate mason titled kentucky participated jennifer "
    "matrices sts forum sphere seo volunt stellar forall imet configured abol igent delayed ffic scent disgust hesis imen reign ulas uming innings idity "
    "dozens warf delhi biological corridor suits iago divide exterior finest bir freed fruits servants publisher copper olation chairman tik mothers jeans "
    "reveals unconscious hacer riculum orsz canal allocation acking motivation iges fires heute skiej orleans ylan warmth welfare jem kee seguito unge yoga "
    "dug restored droid ranking ographical pian gates implicit pope scattering allocate manhattan interrupted cules identifying digit elia invoke floren "
    "shallow getclass advertis yman secured relatives sob stab kont hacia antib umbs tracker merc poc purely gorgeous riven romance traject arise swung "
    "pockets traditions rever divis beloved quantities iendo talented immigration juris aer eaten miejsc summon gains restriction bout slavery computation "
    "armor muslims cooperation enhanced oslav abrupt podcast hospitals hotels wikipedia communist angles thigh kirk tends delet popul diesem empower dealt "
    "estad credits subsubsection physician gob shaller cared oficial jel rapp annie stocks developer lavor accus amerikan sketch sentiment rendered laund "
    "nons blew ategor nosti commerce twin dedic differential emark feared sko invention ermine caract loyd delicate ulent obra banda otta kole ilio outputs "
    "estro aaaaaaaa nent spy crap incoming upstairs ioned ighbor expectation imedia earliest ollen rake patience buyers adjusted imeq ellers ruin frederick "
    "ottage comprom iasm encouraging beans perceived globe herent alike hurried musicians arz dropdown acl preview underneath females peers atra furt illas "
    "sof cleveland butt inevitable amine beiden cuba philippines jal tatto unately terrain crop essen fist zoom ruling assy orent gibt simeq freely "
    "diagnosis chips razor comparable analys clusive voyage schl grouplayout oise crush bekan einwohner dressing solved chel pared sealed ancouver seh mour "
    "cleanup makers siglo cec herz genius owego ioc fever satellite beng curt documentary grasp dla readily cooked rolog annoying nigeria dai sacrific "
    "servant barg coupled ungle portrait dental destro rue hybrid klahoma aiser solving lista evans fusion complaint heap displaystyle insn kilomet "
    "delivering shine probable hren nep overnight pread clo iesa objectives colours xico lightly scenarios appet deport menos paulo caring electro colored "
    "itsch ropolitan osti consecutive arness afka cip toys miser checkbox fisher governed trivial occupation rors mou bord artic mientras uations commented "
    "triggered marcus punct achievement aders jours irlines napole porque liability triple secur handsome dod acja chod esar sophie amous suppress kilom "
    "belonged proces pam tales spreading leased nonnull cater tire porch quier swiss brave explosion classified dublin separately banking christianity "
    "employers analyst harass aunt llev nit wreck patrol loyalty nationale gom dispute limp urbed miejsce developments varying asis creativity ieux "
    "provisions uve phony outline elm uced yna ocate cares fins smallest recv keyword attra selbst unset homeless johannes antage inhib appreciated ielte "
    "stays alleged coding filepath accepting luther tightly unnecessary stringbuilder enburg vma abraham hugh bulgar avoided poems avirus ueva flix "
    "charging motivated aveva flexibility agna racism baking bler attachment bajo pricing volution amas adapted oxy rico collapsed plo bitcoin gow chez "
    "otro investing aboard flights genuinely promising suoi stringify acies sequences cure outine gardens taiwan inspection pmatrix regulation sprite "
    "confeder immigrants elderly umed gateway fony cosm ignoring sensitivity engineers correl irteen switzerland midnight akte esper universidad dern inge "
    "invitation essays chsel confirmation unity tray federation reun peoples iores oubt charm ieur utilize distribute gotta blocking bonds dice norman "
    "inspir puerto rst quale crowded hbar loads correction textsc cooling iveau betting implications poz regards amid habitantes requiring drupal czas "
    "lyrics nort mey hir statue borne heritage dorm lever muttered intermediate watson viewing ktor entieth atu toute iglia ichi exhibit asympt gulf lately "
    "defining omorphic sempre clearing diameter indo soccer dcheck nomin directors moderate bapt treating agi ringe ellan fino sic stamp buen segundo "
    "inverse broker searched isha nicholas swedish hemal jego discret amon navigate disappear graphic seal cement otti theod removeclass julie keine "
    "continent jaar kreis crown axy intend bub masks situated participating preferences violation primitive illance ranging substr nez przed merged uros "
    "aran iliation keith ownproperty opsis defence criptors beaten intimate opic rename productive ribly klub enario pseud quelques punto senal diabetes "
    "personas crtc frustration drawable bore arator agricultural etection heels cccc vessels ecycle winds nehmen heinrich omsnitt hos equity collecting "
    "lifting subfigure winners usd stesso altri producers mons ablo overlay idiot uble ierre minecraft fos encuentra screamed polynomial cone cited "
    "presidente resign yelled reli alumin shelf appendchild logs punk borders flaw cinema abortion initions turner inus eves magazines lace slider locate "
    "desarroll landes olia unm senator administer gele drank posing ensemble scriber champ nio onces sunlight muse curiosity ylon relativ azu persona wides "
    "kas icies consolid interactive oping energies independently innerhtml absurd scholars achte aments trucks rewards ogs inherited imated extens glow "
    "ardi evaluated cleaned habil dece contempl acquisition sectors trabaj mitt wang wend cameron iels roe distinguish privilege delighted deployment "
    "contributor threatening regiment declined xtures historia withd borough tossed jumping manually sap questa norway ugg fascinating byla consistency "
    "elcome plicated exploration foram compliment senses clas highlights dessen skulle overview blast atrice enthusiasm characterized etary spectra honour "
    "phases jap surprisingly decoder sexy cedes iteration calc infant sofa lauren eenth devient dings ukrain spawn yect roth cattle styled lanc churchill "
    "roi ibut entin urge baron devil assem januari thy sri halfway encoded itize sore byname allies competing cticut graded screening rijk adequate vag "
    "wyst mainstream drm illion erhielt vain attering mejor streak sophisticated rhe ussy syria caroline riterion cycles medieval missions phoenix sampling "
    "dismissed propri judges ulos lion locals ogeneous dici authorized zerw entrepreneur vancouver itating acknowledged tourist gebru berger marcel "
    "anonymous bycomparator eventhandler tours lonely ameter reviewed irat nerve linda decis spokes qued ousing opponents ogg tyler ijuana publications "
    "vised writeline remainder sequently collision harrison workplace consume avoiding charts pav ualmente aned rdev sheer angl bev campo lecture baltimore "
    "keiten lasted discrimination igte okal titel diagnostic sung giornata osta isco sara rosen pher ralph wordpress antry picks cheduled kie "
    "representations essment countless yme bened chars longest frica bef mechanisms heter athletes periodic maid swear wiped graphs thesis sensation "
    "persistence acs deel scrib iero discre airy datasource iciones respected fram specialized complaints disse consumed isy patent sach cyber blake bloom "
    "shah inclusion manera isches opath efficiently toolbar neil formats fonction caval hob hely admission umbling booking bland submission fections "
    "distinguished arrange umeric ipage aunque inserted smithy bak achen eau xvi tactics formatter tram parish raymond contempor desires miner qualify iku "
    "derni anean holland hamiltonian jsp thailand relieved oklahoma julian ifr flame onio shifts caracter ificates gfp maine codeattribute ervation shy "
    "particul hypothesis athol swith lemon milan anten sia rias consid asso ainers circa nuevo mediterr turkish ionen evolved hanno onial closet stride "
    "epid attacking vita stating envelope volatile defending aal mong refriger parked lighter testimony harper debugger ologically compiled graf hallway "
    "norte loren phr inters convergence uese valor esen utah natal modest adr proxim sburgh edific queries archive pine beast determining junk creep cols "
    "portions imos stevens numeric guided chten imprison mayo eken faded widespread negro lando catching cere illegalargument portland stuart ernal penis "
    "brutal arrays equipo ondo eof sentences avg haar households unders accompanying epic angs parency lloyd gmail upiter alties copied oki psychology "
    "epoch kinder completing presid nested effectiveness incorporated toujours souls interven eks schemes dzie olph witch merchant infan spher addiction "
    "registers achi penetr auses prescription printstacktrace trunc opcode agricult recipient uits yang grinding armen naval selon omas districts icates "
    "shouting agner dello fighter tooltip divisions exponent jokes substitute seam mundial zam ufficient frightened iface otras uffy admiral tijd eward "
    "egyptian atan tackle pecul preserved comprend allo mondiale prow belonging accommodate louise damit scripts shitty believing inhabitants colombia "
    "murphy tremendous swallowed omp anys deadly icts alaska scary secondo heroes veteran behaviors tikz spectacular demo serialized meditation coefficient "
    "slug xviii iao adoles arius rade clause connector connecticut abulary delen suited zec andrea propaganda izioni forgive operates lingu collar zten "
    "imat shoe legally builds ulsion bacteria magnific prisoner liz dennis surge wald warnings quadr atte eins adoption wanna denver jessica acyj emu "
    "stalin aggi fils aju attraction odot nineteenth maggio dummy enci isure porte indi ugno neces overseas ofs arel corrupt interpreted ibile wages "
    "herbert registr morte composite antine initialized poorly accessor hannah olan strikes conflicts surg historian libraries fict blessed etics fork "
    "polation negotiations genus controlling perry spd indul ehemal amplitude photographer invested prolong ichtet carb urst nixon corporations chte "
    "deliberately febr provincia indication pistol ocial sehr okat aye eighteen tug nings todd organisations genes todas illustrated arriving excessive "
    "traits sank dentro bris atoms distances staw wij jek ionato bekannt conclusions ainte passive gaussian stagione itol jeremy classlist desperately verl "
    "brace cob arist dap ultan lasting elementary louisiana pov bruno evangel likelihood nico hui akter neurs breeze dylan biographie onso suppliers tablet "
    "zaw subm fernando nouvelle strangers componentmodel istro aurus sanct harold malloc muham backwards deemed accurately transc broadway grud namen "
    "shifting mentally calories consensus objet elaborate atts snake refres aru reflects ounge kurt pied expedition owen utterly arbe breasts hunger atem "
    "verschied ivals spraw wasser mechanics dbc painter haut marshal isd veloc compte witnessed hurry chet sburg arnold answering olive spont intervals "
    "triangle rally gand santiago itung realised earnings silently edo oooo mages singh revolutionary chrom anterior indonesia sixteen throne audiences "
    "ihren inburgh fico kidn irmingham isle champions oler zak plat viii atique inis scientist keley hyd oft ngc ongs tier shaw establishing indicator "
    "spine teles packaging toire productivity degener yam dough osph clue meille tendency relay designers bicy masters alternatives countr wow enue slim "
    "tir doit lica cipe izia concentrate negl gott studios owym taxi seau heimer dia irr urged anom tarde urm seized opacity deciding listeners planted "
    "ngth cav measuring necessity rivers laboratory reproduce sak notebook reasonably iseconds revealing conviction alternate cciones canonical liminary "
    "hamburg influential bolt azzo saudi cerca decorated staat competitors diamond mobil clicklistener setstate ludwig clinic threading fract ossip ifacts "
    "pets addressing udder verbose ersch communes commut klass voltage rezent fame casting engl intro clicking flames randomly equalto anners parks "
    "murmured reasoning meer typing happily becca oracle equilibrium lite desktop gill dorf igg consisted abu vscale aho hesitated wenn mapsto "
    "controversial lac itta ulin cler diana freud challenged seated smiles cracked diction imposed protests wounds preventdefault adio secolo founding "
    "retro potatoes ieme yside tilt unters udge unal impat repairs ferd pagina obligation ighed persistent certification uld skirt discrete teas audit "
    "whoever bald inferior leak pix companions accessed posto pursuit owi grocery hausen normalized trauma ggi ienia autumn sovere menschen gentleman "
    "inging subur aceut ceremon outfit agriculture springs tecn emos pieler ritz tabs inand ocon buyer usement settembre ppe wives marca descent verts hugo "
    "osity consultation erano lovers virtue viewers overlook jev provin tiles argc templates arb weitere toll correspondence decess builtin dash zenie "
    "molecular chemicals rendering martha riere asters decides florence anders affiliate revision fiscal dependencies rack naissance prv radar vivid opf "
    "rys ilians likewise lil campeonato reno michelle cancelled rebell osz composer deserves ohne practition indoor configurations meth blown deven "
    "istrzost naio comed stam travelling naire autonom considerably ladder hast izado sele ardon anticipated elseif blues filtered auction inx sucks hudson "
    "femme inho istributions petition bears hollow dims complained mapped initiatives owns dispon mush erfolg norweg cet stalk uvo ierz rieben icals stdout "
    "extracted undef accommodation intentions concentrated utilis compris rated peque nim olding urls emissions minded provid civilian finder achieving "
    "requi openly belgium icity stagger nate geoff lli combo hooks guides principale appen ruined sliding octubre poser boom activation entertaining "
    "protective midst phd ijing getc trouve ambers greed amarin suspicious deputy asper funded adays statt fights agh orna hado lungs dive diagonal descrip "
    "britann akov farming kills carib gaining noting barb pere isnull simplicity reinforce linq diffusion disorders uity helpless compression olutely ogue "
    "upward blockly bride parseint isolation regulatory ricane salad wei conspiracy modifier batteries ivas aggregate destruct fourteen bothered elte mism "
    "resting deren diary vague marginal metro earning histoire endorse beard ieb neutr ambit leonard verified enumerable venezuela descriptions valued "
    "chapters clarity tourists tribe advocate rigid congreg startup deadline begann calci incons rubbed apeut uario synchronized unfair rsp societies poker "
    "locks reconc maurice bleeding derivative crushed temporarily coaches kyle sohn creator erik seiz preval determines volk pawn colin ortion steller "
    "imply toutes aning igious eternal bankrupt failures uerte zung containers ousel hiv conced septiembre faz aglia pip lado compatibility versation chick "
    "organize economics ancestors scrub labeled suz alloween rhs asci switching giugno charming eking prit ercise bugs lightning lengths elines tragedy "
    "intendo abundance evac itably recib uated foolish despair compromise personen investigated exclude televis pulls accordingly formally lily iefs "
    "treasure httpservlet disclaimer luss rogen selecting assure frustrated escort aises uning pte bend jewelry stockholm warner shaft cann pittsburgh "
    "irical gennaio annte pshire printer damages isaac thrift technically tricks needing gir rehe reminder shiver struggles genom imil gloves inclusive "
    "ogan poque contrib mama prints renamed netdev draws mum spieler transit compress purchases performs demol commence cush muhammad netflix wir refugees "
    "birmingham introducing scholarship ifa iblic istributed departments malaysia claud numpy projected reminds ibling slower ropic montreal detective rosa "
    "seventh fff ickets adaptation supers accessories distress goog farmer itational asshole molto algo congr deserialize chemistry animated kum drums "
    "programa unned ynamics cosystem anime ibm needle esser inclu abases warz stepping einstein ponential neural ubic facilitate minipage worm wicklung "
    "spouse survivors atype cognitive enabling societ clan excluded thunder entropy fastest vienna flowing affirm alom hips cannab sticks curriculum "
    "retained extending jeho forests mania slash benfalls textfield continuously jenny chos ambig autow destin auge commod garlic dramatically ancers ghai "
    "twee youngest cage oks iches cury nals dependency eous amateur disability revenge courtesy proves typen terra mineral warrior getdata safer comune "
    "hierarchy resse bros antal mercy maggie sustained buenos dealer enes bbra ipa reporters peculiar supplier rolls preg reyn surrender contributing "
    "township grp terrorist pto onen pearl pillow grades numero centered rhet laundry getnode estimation wholes constitutional amination adt publi dicembre "
    "efe atched estr appel tcx sek advise iaz broader junio wool hatred exagger ktur tdm feas jsou shir associations itations orum tires arto edinburgh "
    "invented hindu urgent textcolor werp detector altered membr stylesheet unts nutrition sylv mines litter concurrent swallow deutschen domains mcdonald "
    "candle plural sharply origine candy kilometres powered bernie ernst rebecca suffix julio provincial appreciation cricket torture utton outbreak "
    "preventing madre retire endregion fais remembering alban workout asto fortunate paste otra angen sierra nau sera proposals itte tenant emerge gek "
    "olence otos witnesses watches careers faithful recommendation skich boldmath origins spinning bombs autowired umper ichael contributors nasty drap "
    "budapest urious welcomed wagon embarrassed harvey enjoyable millis dashed exh ahu wsp sebastian achers yaml buddy reste icl chase homme squeezed "
    "possessed attributed rotate prospects surveillance cryst robe jama intimid erei icism nasa pode responding blowing hoff civilization conscience "
    "richmond lington ocratic updating militar pseudo behave distinctive journalists spun durable twentieth enson selfish arium decid psychiat ugu "
    "ancellationtoken grants tig accepts systematic ausge dialect erme mistaken mannschaft cough lamb surviving sway sog newer exemple litt emitter getter "
    "orable fick ikh itr homework middleware wells enero emperaturen reagan compelling tribes paces harmful odio mim getitem assembled elin phabet toast "
    "tutti bezeichnet ettes regener isce toda ethical arin igos workshops roche daw arians impacts portable relev ardless ulously olent combinations rejo "
    "traces icion emotionally joel legendary iba midt ensuite authorization helmet territo segunda recated invoked valueerror compilation palmar influences "
    "nop tucked pension generates incap clicked fus ourses easter zin obligations bsd expose amanda guessed dsi leip hughes wahl formerly strang recht "
    "londres elbow hawaii asury steht damned packets elevator iedad mals remem entonces sympathy befindet incing musician listop felix carved nicely nieder "
    "modifications balcon cket vanished fighters ioctl defens curv rogers gratitude denmark grpc immense prevented foam mercedes omena incorporate conde "
    "wasted complaining warriors oter conten machinery technological gras minimize bzw prac mvt klein fade setvalue wallace footage entstand arga nails "
    "capitalism garc suspension ilis uffled xxxx diag textview mle ennen infected therapist cidade bump handy temporal ependant shining idy fran nurses "
    "betray sensible thirteen noah istically appendix recher dernier partido maximal ultra tegen baseline reload arbitro kall quin impse zas brains hostile "
    "marble oons oden documented moses wax usch diagnosed inkle xbox seventy cias noviembre philippe sage unpre apost ellos gbt insist inspire ipart unate "
    "cnn unhappy agles mee bery carriage misunder imagin crowds ranch lacking submar iante lanz obten downstairs jesse puls irling schaus deployed marvel "
    "isine rude niveau atis omm scriptstyle desp eltemperaturen talents ocy raises editorial bss sev mandatory synthetic gown dob harmon liberty prayers "
    "mise confusing leap arrives kamp thats glimpse explored meantime raison existe caution usta gilbert limitation retour commonwealth gewann miserable "
    "networking ottobre sede iros desen parc orio avelength inceton vern romag viagra overlap eventargs questioned permanently lst ficie quella colleges "
    "disappointment luft imgur transitions seller febbra cyr febbraio eti arom claude uefa victorian fixme itime chestr samsung doctrine mediterranean "
    "vault sedan heated frankfurt pectives reserves tobacco fragments icc booth cruise testament cola leop terrified alie verification yster chied datasets "
    "miem ulates brend billboard stern denom accidents packing iblical whisk luego rectangle neglect sober lur rested ambigu tastes amazonaws confess "
    "diciembre absorption zach freeze lbl stm wien anska surn iative amba leen functioning getcontext gart jorge periodo patches engono trfs convex sax "
    "lebens insky schon neys aspir breakdown designing angela confer interference mao absorbed vall errorcode vano deer graz iffe umbing unre siendo "
    "simpler arettes anst hass mois ffen activated internacional mittel getproperty isz cedure enters sally logged kaiser expend aphor brass melod "
    "attitudes bamb cester migrations entric hre polite ahan luglio predecess implementing gev duplicate logan nonsense ecc squadron deprecated aub overl "
    "beautifully gian papa caribbean rai sniff tto incidents duck chelsea pilots traded beijing gregory inclined marian fierce theft parentnode idental "
    "gouvernement ruby monaster kab approximate appers oubtedly towel siblings eph icios outrage weed crops iman insula slammed trailing biography "
    "appealing voj unos transm ierto dignity aired alberto facial mathop cott bunk amiliar turno portuguese questioning xamarin disadv kot cius darwin "
    "mobility barriers gif roh olk farms checker russians naments erset itori costume mathematical nominated restoration posal unfortunate intact provoc "
    "ermo conting doug tops artwork artillery arabia sdvalue dakota iated cottage wherein tutorial scre sweep hostname ocz predomin encial commanded "
    "withdrawal iour seeks ouw rugu ustain consulting lars critique circulation landsc herman afi discour steph tolerance typename ventions sticking "
    "spencer gomery imiter slides edwards cents oya serts saddle slov shiny scrut onden uffs idential annually arkansas gleich perfection shorts justified "
    "peated stripped ecosystem ixa vart treats pity chand inski continually daddy nightmare icional efect ueblo ampton issent glasgow furono kindness "
    "competed disgu stuffed hilar stressed reconstruction understands chaque prejud utat cuatro sidewalk geo rugby financing comply rushing presenting "
    "zeichnung petit allerg worrying mamm realise assumes quand tyard mono blessing eyebrows modeling greeted workspace pedest lemagne aument speeds "
    "syndrome zahl verso astronom aprile gioc comport variance realizing estar sost andr attrib rede toes advances rss mmmm newest phrases anter "
    "manufactured rollment eston peint endet ivalent upright anked mast onchange debris grap etry prevention exotic olin eliminated ospher navig renown "
    "uffed foster realization ctxt ahoo miracle gps observable magnificent ieck vee ippet hillary laying encryption smelled suscept cluded carn igten gfx "
    "oshi relaxation varieties gaps stole igua hampshire initialization oustic josef icating goodness ignorance brist paras accidentally tand ittest "
    "shipped usize carr precip pathetic rived rok digging mull xiii peas foul travels arde stefan memorable nina highlighted memo meisterschaft sidebar "
    "nevada drawer astically elde scribed priests hommes instructor spett sleeve strongest nicole ipper inwon ilers oge depressed combining inted pollution "
    "phillips peripher italien ysz earthqu hecho deserved supportive irrelevant izada ereg comerc ilen esz ablish ripped francesco anytime automated "
    "ostream drawings enhancement okrat wyn izarre attro nintendo salvador adc bennett pueden jin crashed denen quebec itories blinked voce mau orneys "
    "coastal sensors xii illusion oji duncan affecting napoleon compt profitable loe viable textbox luminos affiliates ilda ebenfalls amd corrected "
    "otherapy atisf rost vendors customs blogs strat anje tide brigade getoperand aliment achievements suspicion touchdown iore denomin aleks prevents "
    "clutch mux notably chio nage miche amely rodz destac clara frequencies febrero stumbled prey medio ernest marcatori oport cancellation bryan libre "
    "sandy marina kultur explode limiting presumably lte quinn cuenta varies fluctuations warehouse corrections dhd fals controversy curse idan iliary cule "
    "ignorant aesthetic getint unicode oirs socks imped neue dispers filer frau teens roberto lauf isarray teenager loudly adventures molly inement diz "
    "lessness halloween rebel radial assignments altre flies droit thickness enjo dwell homosexual philos getcurrent veterans berkeley wildlife tos "
    "keywords medications neum jamais buc jackie ordin enze utilized azed severely libro butler puzzle pfn orchestra alto ancora decomposition appetite adu "
    "comenz mina initiated sometime rek geometric proceedings dlg buffalo blacks custody tattoo recuper bem thou oriented colony stanford adrat souvent "
    "apartments windo acci lau manifold coalition xiv ascade wheat strengths ascular plasma separator zag projet smoothly popped utilities hadoop sotto "
    "georges gruppo instrumental settimeout ikk practicing ronald agrees denoted ismiss interviewed xvii positioned overwhelmed reprezent expects marijuana "
    "zaj bren begg nahm interrog bun shelves frauen sergeant donne touches vale institutional ambitious nonetheless backpack surroundings moisture wyd "
    "traders peru priorities pronounced cbs expans energet sver ployed lust atinum oyle surveys bee bbing regation dashboard vista depicted occurring "
    "sandwich rcu minut solete tunn scarc trails kem romans ativity depress resigned getdefault tibet franco injection praised erase commissioned boh cinq "
    "joshua summit curl visa resur absorb planets jahrhunderts nbc neuen bben ejempl considers atri arrog ioso hace contacted unple sponsored trainer sbi "
    "criterion ennial fixing ituted riages haber elasticsearch voll clu membres remarked yale berries releasing imports arqu rangers imaginary specialists "
    "hoof sadly ceil tabindex ationale tbody leverage mam afin isvalid chopped dabei ussia lgbt parti bachelor uga seth liable inaugur shanghai relaxing "
    "obey airlines celt agation worries arith fatalf colm archae brushed structured homem getkey sucked zomb issant rir seas tense atm havet pierws tragic "
    "confidential kenya ocur aniu consultant avorite utilizing vintage matcher membre tracing dej loops archives stove ancies gemeente eso teaches fid nebo "
    "valentine rowning awi ishi spel participant gast blond saves politiker dum dentry hern bever incluy unregister queensland otive alley democrat travail "
    "omes recognised heng jung roland convicted mari luxem referto staats chk typeinfo scandal individually abile wort splitting achten arising sip fres "
    "groom canon abruptly afterward palestinian pgfscope countryside ensors buffers remot proptypes easiest invas blanc samp cohen destroying dater filing "
    "integrate xit lene slaughter unches longitud chunks unemployment acom slowed outlined xffff ikke kicking embedding chnitt erten mmc analyzed coupe "
    "favorites silva anderem honom legt spoon erne vagy analytics sug peaks lawsuit ialis etric disrupt mend nerves doubts sow bangl ipad useppe conducting "
    "harbor psz fifa emor "
).split()
