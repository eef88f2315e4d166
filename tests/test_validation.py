from silverline.functions import validation


def test_email(evaluate):
    good = ["user@gmail.com", "nombre.apellido@empresa.com.mx", "mi_correo@hotmail.com", "Usuario@Gmail.COM"]
    bad = ["noarrobagmail.com", "usuario@", "usuario@gmail", "@sinlocal.com", "", "   ", None, "nodomain"]
    assert evaluate(good + bad, validation.is_valid_email) == [True] * len(good) + [False] * len(bad)


def test_clean_email(evaluate):
    assert evaluate([" U@X.com ", "u@x", None], validation.clean_email) == ["u@x.com", "UNKNOWN", "UNKNOWN"]


def test_phone(evaluate):
    good = ["+1 (555) 123-4567", "555-1234", "+52 55 1234 5678", "123456789012345"]
    bad = ["123", "abc-defg", "", None, "1234567890123456", "   "]
    assert evaluate(good + bad, validation.is_valid_phone) == [True] * len(good) + [False] * len(bad)


def test_clean_phone_keeps_formatting(evaluate):
    assert evaluate([" +1 (555) 123-4567 ", "12"], validation.clean_phone) == ["+1 (555) 123-4567", "UNKNOWN"]


def test_date(evaluate):
    values = ["2024-01-05", "2024-1-5", "abc", None, ""]
    assert evaluate(values, validation.is_valid_date) == [True, False, False, False, False]
    assert evaluate(["05/01/2024"], lambda c: validation.is_valid_date(c, "dd/MM/yyyy")) == [True]
