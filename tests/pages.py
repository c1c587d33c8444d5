"""Small hand-made pages in the three layouts."""


def modern_event(number="101", heading="Power Reactor", fields="", more="", after=""):
    return f"""
<div class="grid border" id="en{number}">
  <div class="th">{heading}</div><div class="th">Event Number: {number}</div>
  <div>{fields}</div>{more}
</div>{after}"""


def modern_page(*events, h1=""):
    return (
        f"<html><body>{h1}<div class='nrc-event-report-day'>" + "".join(events) + "</div></body></html>"
    )


def legacy_event(number="201", heading="Agreement State", left="", right="", cfr="", persons="", after=""):
    return (
        f'<a name="en{number}"></a><br><table><tr><td>{heading}</td><td>Event Number: {number}</td></tr>'
        f"<tr><td>{left}</td><td>{right}</td></tr><tr><td>{cfr}</td><td>{persons}</td></tr></table>{after}"
    )


def legacy_text(text):
    return f"<p><b>Event Text</b></p><table><tr><td>{text}</td></tr></table>"


RULE = "+" + "-" * 78 + "+"


def plaintext_page(*blocks, heading="Event Reports For\n 01/02/1999 - 01/03/1999"):
    return f"<html><body><pre>\n{heading}\n\n" + "\n".join(blocks) + "\n</pre></body></html>"


def plaintext_event(number="301", heading="Power Reactor", rows=(), text="Something happened."):
    boxed = "\n".join(f"|{line.ljust(78)}|" for line in text.split("\n"))
    return "\n".join(
        [
            RULE,
            f"|{heading.ljust(48)}|Event Number:  {number}         |",
            RULE,
            *rows,
            RULE,
            "",
            "                                   EVENT TEXT",
            RULE,
            boxed,
            RULE,
        ]
    )
