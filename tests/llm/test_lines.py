from collections import Counter, defaultdict

from leadpanel.llm import lines

SCHEMA = "doc_id bigint, text string, row string, n_dropped int"


def run(spark, rows, tree=lines.TREE):
    out = lines.deduplicate(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), tree)
    return sorted(map(tuple, out.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


def brute(rows, tree=lines.TREE):
    """The same rules with plain loops; rows that are equal count as one document."""
    import re

    plain, found = [], []  # (document key, n) and the line, or its masked tokens
    for key in {r for r in rows if r[1] is not None}:
        for n, line in enumerate(key[1].split("\n")):
            line = re.sub("[ \t\r\f\x0b]+", " ", line).strip(" ")
            tokens = tuple(lines.FIELD if re.search("[0-9]", t) else t for t in line.split(" "))
            if line:
                plain.append(((key, n), line))
                if len(tokens) >= tree.min_tokens:
                    found.append(((key, n), tokens))

    def order(place):
        return (place[0][0] is not None, place[0][0] or 0, place[0][1], place[1])

    def repeated(named):
        groups = defaultdict(set)
        for place, name in named:
            groups[name].add(place)
        kept = [places for places in groups.values() if len({x[0] for x in places}) >= tree.min_docs]
        return {place for places in kept for place in places if place != min(places, key=order)}

    def leaves(tokens):
        paths = [tokens[:tree.depth]]
        if len(tokens) > tree.depth:
            paths += [tokens[:at] + tokens[at + 1:tree.depth + 1] for at in range(tree.depth)]
        return [(len(tokens), at, path) for at, path in enumerate(paths)]

    counts = Counter((leaf, at, t) for _, tokens in found for leaf in leaves(tokens) for at, t in enumerate(tokens) if t != lines.FIELD)
    general = []
    for place, tokens in found:
        for leaf in leaves(tokens):
            for k in range(lines.STEPS):
                fixed = tuple((at, t) for at, t in enumerate(tokens) if counts[leaf, at, t] >= tree.min_docs * tree.step ** k)
                if len(fixed) >= tree.similarity * len(tokens):
                    general.append((place, (len(tokens), fixed)))
    again = repeated(plain) | repeated(general)
    out = []
    for key in rows:
        if key[1] is None:
            out.append((key[0], None, 0, 0))
            continue
        every = key[1].split("\n")
        left = [line for n, line in enumerate(every) if (key, n) not in again]
        out.append((key[0], "\n".join(left), len(every), len(every) - len(left)))
    return sorted(out, key=repr)


def corpus():
    rows = []
    for at in range(40):
        text = [
            f"Unique {' '.join(chr(97 + at % 26) * (i + 1 + at // 26) for i in range(6))}",
            "Subscribe to our   letter today",  # word for word
            f"Page {at} of the paper now",  # a masked number
            f"This story was posted by {'amy bob cid dan eve fay'.split()[at % 6]} in the news section of the paper",  # one field
            f"{'two one few'.split()[at % 3]} tokens{'.' * (at % 9)}", "",
        ]
        rows.append((at, "\n".join(text if at % 4 else text[:4])))
    return rows


def test_recurring_templates_go_but_their_first_place(spark):
    rows = corpus()
    got = run(spark, rows)
    assert got == brute(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[0][3] == 0  # the first document keeps all
    assert all(r[3] >= 2 for at, r in by_id.items() if at)
    assert "few tokens....." in by_id[5][1] and "Unique f" in by_id[5][1]
    assert all("Subscribe" not in r[1] and "Page" not in r[1] for at, r in by_id.items() if at)


def test_fields_are_generalised(spark):
    rows = [(at, f"alpha beta {chr(97 + at % 26)}{chr(97 + at // 26)}q gamma delta epsilon zeta eta theta iota") for at in range(60)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(r[3] for r in got) == 59


def test_rare_lines_stay(spark):
    rows = [(at, "Said only a few times here") for at in range(9)] + [(50 + at, f"Alone{'x' * at} stands{'y' * at} this line of words") for at in range(30)]  # two fields of six
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(r[3] for r in got) == 0


def test_nulls_repeats_ties_and_long_texts(spark):
    line = "The same footer on every page"
    rows = [(at, line) for at in range(12)] + [
        (None, line), (3, line), (3, line), (100, None), (101, ""), (102, "\n\n"), (103, f"{line}\n{line}"), (104, f"{line}\r\n x{'y' * 100_000}"),
        (105, "\n".join(f"line {i} of a long one" + "z" * (i % 7) for i in range(5_000))), (-5, f"\t{line} "), (106, "9" * 200_000),
    ]
    assert run(spark, rows) == brute(rows)


def test_rows_that_repeat_are_one_document(spark):
    rows = [(1, "One footer for all of us")] * 20
    assert sum(r[3] for r in run(spark, rows)) == 0


def test_empty_table(spark):
    assert run(spark, []) == []


def test_parameters(spark):
    tree = lines.Tree(depth=1, min_tokens=2, min_docs=3, similarity=0.5, step=2)
    rows = [(at, f"hello {'a b c d'.split()[at % 4]} world\nhello you") for at in range(12)]
    got = run(spark, rows, tree)
    assert got == brute(rows, tree)
    assert sum(r[3] for r in got) > 0


def test_rows_that_repeat_add_nothing_to_a_leaf(spark):
    """Four documents, each there five times, stay below the ten that a template needs."""
    rows = [(at, f"alpha beta {'wxyz'[at]} gamma delta epsilon zeta eta theta iota") for at in range(4)] * 5
    rows += [(100 + at, f"alpha beta {' '.join(chr(97 + at) * (i + 1) for i in range(8))}") for at in range(12)]
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[3] for r in got) == 0


def test_templates_of_large_leaves_go(spark):
    """Variants of one word beside many exact copies; the share of the leaf alone would keep all of them."""
    line = "alpha beta {} gamma delta epsilon zeta eta theta iota"
    rows = [(at, line.format("same")) for at in range(1000)]
    rows += [(2000 + at, line.format(f"{chr(97 + at % 26)}{chr(97 + at // 26)}q")) for at in range(45)]
    got = {r[0]: r[3] for r in run(spark, rows)}
    assert sum(got[at] for at in range(1000)) == 999
    assert sum(got[2000 + at] for at in range(45)) == 44 and got[2000] == 0


def test_different_numbers_are_not_one_template(spark):
    rows = [(at, f"{at} {at * 7}.5 2024-01-{at + 10}\nsome words of {at} alone") for at in range(20)]
    rows += [(100 + at, f"12 34 {'9' * 5_000}\n{'8 ' * 20_000}") for at in range(12)]
    got = {r[0]: r for r in run(spark, rows)}
    assert all(got[at][1].startswith(f"{at} {at * 7}.5") for at in range(20))
    assert got[100][3] == 0 and all(got[100 + at][3] == 2 for at in range(1, 12))


def test_lines_with_many_fields_recur_word_for_word_only(spark):
    """Rows of a table, scores and prices are content: less than four fifths of them are fixed."""
    rows = [(at, f"Item {at} {at * 3} {at + 7} {at * 11}\nPage {at} of {at + 3}\nTotal {at}") for at in range(40)]
    rows += [(100 + at, "Item 1 2 3 4") for at in range(12)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(r[3] for r in got if r[0] < 100) == 0 and sum(r[3] for r in got if r[0] >= 100) == 11


def test_short_lines_recur_word_for_word(spark):
    rows = [(at, "Read more" if at % 2 else "Top") for at in range(500)] + [(900 + at, f"word{chr(97 + at)} x") for at in range(20)]
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[3] for r in got) == 498


def test_a_variable_first_or_second_token(spark):
    name = lambda at: f"{chr(97 + at % 26)}{chr(97 + at // 26)}name"
    first = "{} liked this story about the city council meeting today"
    second = "Then {} wrote more about the council of our old town"
    rows = [(at, first.format(name(at)) + "\n" + second.format(name(at))) for at in range(60)]
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[3] for r in got) == 2 * 59


def test_common_values_of_two_fields(spark):
    """Each value is in many lines, each pair of values in few: more lines share the rest."""
    rows = []
    for at in range(300):
        left, right = f"{chr(97 + at % 15)}one", f"{chr(97 + at // 20)}two"
        rows.append((at, f"all who came on {left} and on {right} may leave the hall by the north door tonight"))
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[3] for r in got) == 299


def test_one_rule_for_leaves_of_any_size(spark):
    """A template in a dozen documents goes, beside five thousand other lines of its leaf too."""
    line = "alpha beta {} gamma delta epsilon zeta eta theta iota"
    rows = [(at, line.format(f"{chr(97 + at)}q")) for at in range(12)]
    other = [(100 + at, f"alpha beta {' '.join(f'{chr(97 + (at * k) % 23)}{k * at % 7 * chr(120)}w' for k in range(1, 9))}") for at in range(5000)]
    small = {r[0]: r[3] for r in run(spark, rows)}
    large = {r[0]: r[3] for r in run(spark, rows + other)}
    assert sum(small.values()) == 11 and all(large[at] == small[at] for at in small)
