from thermoweave.llm.lines import drop_common_lines, line_report


def test_shared_lines_go_and_order_stays(frame):
    rows = [(i, f"Top\n own {i} \nshared line\nend {i}") for i in range(10)] + [(10, "top \nx"), (11, "\n\n")]
    out = {r.doc_id: r.text for r in drop_common_lines(frame(rows)).collect()}
    assert out[3] == " own 3 \nend 3"
    assert out[10] == "x"  # eleven documents have "top", ten "shared line"
    assert out[11] == "\n\n"


def test_a_document_counts_once_and_threshold_is_exact(frame):
    nine = [(i, "again\nagain") for i in range(9)]
    assert all(r.n_dropped == 0 for r in line_report(frame(nine)).collect())
    assert all(r.n_dropped == 2 for r in line_report(frame([*nine, (9, "AGAIN\nagain ")])).collect())


def test_odd_rows(frame, odd_rows):
    got = drop_common_lines(frame(odd_rows))
    assert got.columns == frame(odd_rows).columns
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(
        map(str, frame(odd_rows).select("doc_id", "text").collect())
    )
    report = {r.doc_id: r for r in line_report(frame(odd_rows)).collect()}
    assert (report[1].n_lines, report[2].n_lines, report[3].n_lines) == (1, 1, 2)
    assert line_report(frame([])).count() == 0
