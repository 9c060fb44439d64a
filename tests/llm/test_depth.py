"""Parts of messages at any depth."""

from __future__ import annotations

import base64

from queuescope.llm.mailtext import parts


def test_parts_are_decoded_at_any_depth():
    said = "a passage far inside the message, in base64"
    text = "Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n" + base64.b64encode(said.encode()).decode()
    for i in range(1500):
        text = f'Content-Type: multipart/mixed; boundary="b{i}x"\n\n--b{i}x\n{text}\n--b{i}x\n\nafter {i}\n--b{i}x--\n' if i % 2 else f"Content-Type: message/rfc822\n\n{text}"
    found = [p.text.strip() for p in parts(text)]
    assert found == [said, *[f"after {i}" for i in range(1, 1500, 2)]]
